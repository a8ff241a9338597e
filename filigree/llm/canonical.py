"""One consistent form for text that looks the same but differs in characters.

A longest-match transducer over grapheme clusters is compiled once from rules
on the Unicode database plus the tables below. Its mapping covers widths,
ligatures, spaces, invisible characters, composed and decomposed accents and
look-alike letters, is checked for conflicts when built, and is applied in one
pass. What a reader can see stays: case, digits, quotes, dashes, signs, the
presence of an accent, superscripts.

Defined results: a null text has a null form and takes no part in pairs; an
empty text has the empty form; equal texts are never paired; repeated document
ids count once for every different text they hold, and never pair with
themselves.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches, stage

# Letters with the shape of a Latin letter, by script and case.
CYRILLIC_UPPER = dict(zip("АВЕЅІЈКМНОРСТХҮԚԜ", "ABESIJKMHOPCTXYQW"))
CYRILLIC_LOWER = dict(zip("аеѕіјорсухһԁԛԝү", "aesijopcyxhdqwy"))
GREEK_UPPER = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"))
GREEK_LOWER = dict(zip("ονϲϳ", "ovcj"))
ARMENIAN = dict(zip("օսհոՏՕ", "ouhnSO"))
LATIN_LOOKALIKES = dict(zip("ɑɡɩ", "agi"))
LOOKALIKES = CYRILLIC_UPPER | CYRILLIC_LOWER | GREEK_UPPER | GREEK_LOWER | ARMENIAN | LATIN_LOOKALIKES

# Format characters that do show on screen, and fillers without the format category that do not.
SHOWN_FORMATS = set("؀؁؂؃؄؅۝܏࢐࢑࣢\U000110bd\U000110cd")
FILLERS = set("͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ")
LINE_ENDS = {"\r": "\n", "\x85": "\n", " ": "\n", " ": "\n"}
SHOWN_SPACES = set("  ")


def _invisible(ch: str) -> bool:
    if ch in FILLERS:
        return True
    kind, code = unicodedata.category(ch), ord(ch)
    if kind == "Cf":
        return ch not in SHOWN_FORMATS
    return 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or (kind == "Cc" and ch not in "\t\n" and ch not in LINE_ENDS)


def _simple(ch: str) -> str | None:
    """The mapping of one character by the first rule that holds, or None."""
    if ch in LINE_ENDS:
        return LINE_ENDS[ch]
    if _invisible(ch):
        return ""
    if unicodedata.category(ch) == "Zs":
        return None if ch in SHOWN_SPACES else " "
    parts = unicodedata.decomposition(ch).split()
    if parts and (parts[0] in ("<wide>", "<narrow>") or (parts[0] == "<compat>" and "LIGATURE" in unicodedata.name(ch, ""))):
        return "".join(_fold(x) for x in unicodedata.normalize("NFKC", ch))
    return None


def _fold(ch: str) -> str:
    """A visible character's form: decomposed, its letters replaced by the Latin shape, composed again."""
    got = _simple(ch)
    if got is not None:
        return got
    return unicodedata.normalize("NFC", "".join(LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFD", ch)))


class _Chars(dict):
    """Code point to form for ``str.translate``; what is not mapped stands for itself."""

    def __missing__(self, code: int) -> int:
        self[code] = code
        return code


class Transducer:
    """The compiled mapping.

    Clusters are matched longest first: a base with all marks and invisible
    characters after it, or CR LF, before a single character. A text all of
    whose clusters are single characters takes the same mapping as a character
    table, which gives the same form faster.
    """

    KEPT = 100_000

    def __init__(self) -> None:
        self.clusters: dict[str, str] = {"\r\n": "\n"}
        loose = []
        for code in range(sys.maxunicode + 1):
            ch = chr(code)
            kind = unicodedata.category(ch)
            if kind in ("Cn", "Co", "Cs"):
                continue
            if kind in ("Mn", "Mc", "Me") or _invisible(ch):
                loose.append(code)
                self.clusters[ch] = "" if _invisible(ch) else unicodedata.normalize("NFC", ch)
            elif (form := _fold(ch)) != ch:
                self.clusters[ch] = form
        single = {x: y for x, y in self.clusters.items() if len(x) == 1}
        for ch, form in single.items():
            again = "".join(single.get(x, x) for x in form)
            if unicodedata.normalize("NFC", again) != form:
                raise ValueError(f"conflicting mapping: {ch!r} to {form!r} to {again!r}")
        self._chars = _Chars((ord(x), y) for x, y in single.items() if x != y)
        # ASCII and Latin-1 letters and signs map to themselves; only texts with others need a closer look
        self._plain = re.compile("[\x00-\x08\x0b-\x1f\x7f-\xa0\xadĀ-\U0010ffff]")
        tail = _char_class(c for c in loose if c < 0x10000)
        self._tail = re.compile(f"\r\n|[{tail}]|[\U00010000-\U0010ffff]")
        mapped = _char_class(ord(x) for x in single)
        tails = _char_class(loose)
        self._cluster = re.compile(f"\r\n|.[{tails}]+|[{mapped}]", re.DOTALL)

    def _form(self, cluster: str) -> str:
        form = self.clusters.get(cluster)
        if form is None:
            seen = "".join(LOOKALIKES.get(y, y) for x in cluster if not _invisible(x) for y in unicodedata.normalize("NFD", _fold(x)))
            form = unicodedata.normalize("NFC", seen)
            if len(self.clusters) < self.KEPT:
                self.clusters[cluster] = form
        return form

    def apply(self, text: str) -> str:
        if not self._plain.search(text):
            return text
        if self._tail.search(text):
            form = self._cluster.sub(lambda m: self._form(m.group()), text)
        else:
            form = text.translate(self._chars)
        # composing closes the gap where a cluster's form meets the next
        return form if unicodedata.is_normalized("NFC", form) else unicodedata.normalize("NFC", form)


def _char_class(codes) -> str:
    """Body of a regex class, by ranges."""
    out, start, last = [], None, None
    for code in [*sorted(set(codes)), None]:
        if start is not None and (code is None or code != last + 1):
            out.append(f"\\U{start:08x}-\\U{last:08x}" if last > start else f"\\U{start:08x}")
            start = None
        if start is None:
            start = code
        last = code
    return "".join(out)


@cache
def transducer() -> Transducer:
    return Transducer()


def canonical_text(text: str | None) -> str | None:
    return None if text is None else transducer().apply(text)


def canonicalize(df: DataFrame, text: str = "text", out: str = "canonical") -> DataFrame:
    """``df`` with one more column, the consistent form of ``text``; ``out`` replaces a column of that name."""
    bound_batches(df.sparkSession)

    @F.pandas_udf("string")
    def form(texts):
        apply = transducer().apply
        return texts.map(lambda t: None if t is None else apply(t))

    return df.withColumn(out, form(F.col(text).cast("string")))


def _fingerprints(batches):
    apply = transducer().apply
    for batch in batches:
        keys, raws, forms = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is None or key is None:
                continue
            form = apply(text)
            raw = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
            keys.append(key)
            raws.append(raw)
            forms.append(raw if form is text else xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass")))
        yield pa.record_batch([pa.array(keys, batch.column(0).type), pa.array(forms, pa.binary()), pa.array(raws, pa.binary())], ["key", "form", "raw"])


def fingerprints(df: DataFrame, key: str, text: str = "text", min_chars: int = 0) -> DataFrame:
    """(key, form, raw): 128-bit hashes of the consistent form and of the text itself, for texts of ``min_chars`` or more."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(F.length("text") >= min_chars)
    return rows.mapInArrow(_fingerprints, f"key {df.schema[key].dataType.simpleString()}, form binary, raw binary")


def lookalike_classes(prints: DataFrame) -> DataFrame:
    """(form, raw): the different texts of each form that has more than one.

    Counting is over distinct (form, raw), combined before the shuffle, so
    copies of one text, however many, are one row here.
    """
    texts = prints.select("form", "raw").distinct()
    mixed = texts.groupBy("form").agg(F.count("*").alias("n")).where("n > 1").select("form")
    return texts.join(mixed, "form")


def lookalike_pairs(df: DataFrame, key: str, text: str = "text", min_chars: int = 30) -> DataFrame:
    """(a, b), a < b: rows that read the same but are not equal.

    Classes of equal texts are paired first and then expanded to their rows,
    so pairs of equal texts are never made.
    """
    prints = stage(fingerprints(df, key, text, min_chars).distinct(), label="form-prints")
    texts = lookalike_classes(prints)
    left = texts.select("form", F.col("raw").alias("raw_a"))
    right = texts.select("form", F.col("raw").alias("raw_b"))
    pairs = left.join(right, "form").where("raw_a < raw_b").select("raw_a", "raw_b")
    rows = prints.select("key", "raw")
    found = pairs.join(rows.withColumnsRenamed({"key": "x", "raw": "raw_a"}), "raw_a").join(rows.withColumnsRenamed({"key": "y", "raw": "raw_b"}), "raw_b")
    return found.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
