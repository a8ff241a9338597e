"""Items of an annual report found in its markdown."""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches

# Items with a title that must follow, items found by number alone, and headings used instead of items.
TITLED = {"1": r"Business", "1A": r"Risk\s+Factors", "7": r"Management", "9": r"Changes", "10": r"Directors", "11": r"Executive\s+Compensation"}
PLAIN = ["1B", "1C", "2", "7A", "8", "9A", "9B", "9C", "12", "13", "14", "15", "16"]
HEADINGS = {
    "1": [r"Overview\s*\n", r"Our\s+Business\s*\n"], "1A": [r"Risk\s+Factors\s*\n"], "7": [r"Management.*Discussion\s+and\s+Analysis"],
    "10": [r"Information\s+About.*Executive\s+Officers", r"Executive\s+Officers", r"Directors.*Executive\s+Officers"], "11": [r"Executive\s+Compensation\s*\n"],
}
LEAST, WITHOUT_END, INDEX_WINDOW = 15, 100_000, 5_000


@cache
def _compiled(body: str) -> re.Pattern:
    return re.compile(r"(?:^|\n)\s*" + body, re.IGNORECASE | re.MULTILINE)


def _starts(item: str) -> list[re.Pattern]:
    if item in TITLED:
        return [_compiled(rf"ITEM\s+{item}[.\s]+{TITLED[item]}"), _compiled(rf"ITEM\s+{item}[.\s]*\n")]
    return [_compiled(rf"ITEM\s+{item}[.\s]")] if item in PLAIN else []


_ENDS = (r"ITEM\s+\d+[A-C]?[.\s]", r"#+\s*(?:PART\s+[IV]+|SIGNATURES?)\b")


def _cut(markdown: str, m: re.Match) -> str:
    """From a match to the next item, wherever the first kind of end stands; without one, up to a fixed length."""
    for body in _ENDS:
        if end := _compiled(body).search(markdown, m.end()):
            return markdown[m.start() : end.start()].strip()
    return markdown[m.start() : m.start() + WITHOUT_END].strip()


def find(markdown: str | None, item: str) -> tuple[str, str] | None:
    """(text, how) of an item: by its number, by a heading, or by the title that a cross-reference index gives it."""
    item = re.sub(r"^ITEM\s*", "", item.upper().strip())
    if not markdown or not item:
        return None
    for how, patterns in (("standard", _starts(item)), ("heading", [_compiled(r"#+\s*" + h) for h in HEADINGS.get(item, [])])):
        m = next((m for p in patterns if (m := p.search(markdown))), None)
        if m and len(text := _cut(markdown, m)) > LEAST:
            return text, how
    if index := re.search(r"Cross-Reference Index", markdown, re.IGNORECASE):
        window = markdown[index.start() : index.start() + INDEX_WINDOW]
        title = re.search(rf"Item\s+{re.escape(item)}\b[^\n]*?([A-Z][a-z]+(?: +[A-Z][a-z]+)*)", window)
        if title and (m := _compiled(rf"#+\s*{re.escape(title[1].strip())}\s*\n").search(markdown)) and len(text := _cut(markdown, m)) > LEAST:
            return text, "cross_reference"
    return None


def extract(documents: DataFrame, key: str, markdown: str, items: list[str]) -> DataFrame:
    """(key, item, text, how): the given items of each document, where found."""
    bound_batches(documents.sparkSession)

    def work(batches):
        for b in batches:
            at, rows = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                for item in items:
                    if got := find(text, item):
                        at.append(i)
                        rows.append((item, *got))
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, pa.string()) for c in cols]], ["key", "item", "text", "how"])

    rows = documents.select(F.col(key).alias("key"), F.col(markdown).cast("string").alias("text"))
    return rows.mapInArrow(work, f"key {documents.schema[key].dataType.simpleString()}, item string, text string, how string")


def split_at_items(documents: DataFrame, key: str, markdown: str) -> DataFrame:
    """(key, part, item, text): a document cut at its lines ``Item N. title``; one without any stays whole, without an item.

    Expressed with built-in functions: the lines are marked, the text is split
    at the marks, and what stands before the first is dropped.
    """
    mark = "\u0001"
    lined = F.regexp_replace(F.concat(F.lit("\n"), F.col(markdown)), r"(?i)\n[ \t]*((?:#+[ \t]*|\*\*)?item[ \t]+\d+[a-c]?[.:])", f"{mark}$1")
    parts = documents.where(F.col(markdown).isNotNull()).select(F.col(key).alias("key"), F.split(lined, mark).alias("parts"))
    parts = parts.select("key", F.when(F.size("parts") > 1, F.slice("parts", 2, F.size("parts"))).otherwise(F.col("parts")).alias("parts"), (F.size("parts") > 1).alias("cut"))
    rows = parts.select("key", "cut", F.posexplode("parts").alias("part", "text"))
    item = F.upper(F.regexp_extract("text", r"(?i)item[ \t]+(\d+[a-c]?)[.:]", 1))
    return rows.select("key", "part", F.when(F.col("cut"), item).alias("item"), F.trim(F.regexp_replace("text", "^\n", "")).alias("text"))


def tiers(rows: DataFrame, table: Column, pattern: Column, other: Column, table_chars: int = 1000) -> DataFrame:
    """Adds (text, tier): the stored text if long enough, else what the patterns found, else another source."""
    text = F.when(F.length(table) > table_chars, table).when(F.length(pattern) > LEAST, pattern).when(F.length(other) > LEAST, other)
    tier = F.when(F.length(table) > table_chars, "table").when(F.length(pattern) > LEAST, "pattern").when(F.length(other) > LEAST, "other").otherwise("none")
    return rows.withColumn("text", text).withColumn("tier", tier)
