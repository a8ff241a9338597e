"""Scalar functions over text, all of them built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKENS_PER_WORD = 1.33


def word_count(col: Column) -> Column:
    """Runs of characters that are not white space; null text has none."""
    return F.when(col.isNull() | (F.trim(F.regexp_replace(col, r"\s+", " ")) == ""), 0).otherwise(F.size(F.split(F.trim(F.regexp_replace(col, r"\s+", " ")), " ")))


def token_estimate(col: Column, per_word: float = TOKENS_PER_WORD) -> Column:
    return F.floor(word_count(col) * F.lit(per_word)).cast("int")


def quality_score(words: Column, full: int = 50_000) -> Column:
    return F.least(F.lit(100.0), words / F.lit(float(full)) * 100)


def camel_label(col: Column) -> Column:
    """A blank before every capital letter."""
    return F.trim(F.regexp_replace(col, "([A-Z])", " $1"))


def plain_number(col: Column) -> Column:
    return F.replace(F.trim(col), F.lit(","), F.lit("")).try_cast("decimal(20,4)")


def severity_score(col: Column) -> Column:
    """A fifth of the severity, at most 1; missing and zero count as 3."""
    return F.least(F.lit(1.0), F.when(col.isNull() | (col == 0), 3).otherwise(col) / F.lit(5.0))


def hop_decay(score: Column, hop: Column, rate: float = 0.85) -> Column:
    return score * F.pow(F.lit(rate), hop)


def tagged_body(col: Column) -> Column:
    """What stands between <TEXT> and </TEXT> of a submission of type 10-K, else the whole."""
    body = F.regexp_extract(col, r"(?s)<TEXT>(.*?)</TEXT>", 1)
    return F.when(col.contains("<TYPE>10-K") & (body != ""), body).otherwise(col)


def ticker_like(col: Column, stop: list[str]) -> Column:
    """Words of two to five capitals, without the stop words, in order, repeated ones kept; letters beyond ASCII are part of a word."""
    found = F.regexp_extract_all(F.regexp_replace(col, r"[^\x00-\x7F]", "x"), F.lit(r"\b([A-Z]{2,5})\b"), 1)
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null for arrays without direction or of different lengths."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)
