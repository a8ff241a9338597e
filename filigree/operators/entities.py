"""Entities by rules: terms of a dictionary, amounts, dates and counts, with filters for noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_TERMS = ["net sales", "royalty income", "deferred revenue", "litigation reserves", "warranty costs", "tax credits", "goodwill", "severance", "freight expense", "capital spending", "dividend", "rebates", "interest", "term loan", "credit line"]
RISK_TERMS = ["cyber incident", "currency moves", "tariff changes", "recall", "lower volumes", "longer lead times", "litigation", "flood"]
ROMAN = r"^(?:I|II|III|IV|V|VI|VII|VIII|IX|X)$"
PHONE, ZIP, SMALL = r"^\(?\d{3}\)?[-. ]?\d{3}[-.]\d{4}", r"^\d{5}(?:-\d{4})?$", r"^\d{1,2}$"
FREQUENCY = r"(?i)^(?:annual|annually|quarterly|monthly|weekly|daily|yearly|fiscal)$"
MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"


def alternation(words: list[str]) -> str:
    """A pattern of whole terms, longer ones first."""
    return "(?i)\\b(" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")\\b"


def is_count(col: Column) -> Column:
    """No telephone number, zip code, Roman numeral or page number."""
    t = F.trim(col)
    return ~(t.rlike(PHONE) | t.rlike(ZIP) | t.rlike(ROMAN) | t.rlike(SMALL))


def is_date(col: Column) -> Column:
    """A year of 1900 to 2100, a quarter of a year, a month with day or year, or an ISO date; no word for a frequency."""
    t = F.trim(col)
    year = F.regexp_extract(t, r"\b(\d{4})\b", 1).try_cast("int")
    shaped = t.rlike(r"^\d{4}$") | t.rlike(r"(?i)^q[1-4] \d{4}$") | t.rlike(rf"(?i)^(?:{MONTH})\.? (?:\d{{1,2}},? )?\d{{4}}$") | t.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return ~t.rlike(FREQUENCY) & shaped & F.coalesce(year.between(1900, 2100), F.lit(False))


def extract(texts: DataFrame, metrics: list[str] = METRIC_TERMS, risks: list[str] = RISK_TERMS) -> DataFrame:
    """(id, type, text): every hit of the rules in texts (id, text), in lower case for dictionary terms."""
    t = F.col("text")
    kinds = {
        "METRIC": F.transform(F.regexp_extract_all(t, F.lit(alternation(metrics)), 1), F.lower),
        "RISK": F.transform(F.regexp_extract_all(t, F.lit(alternation(risks)), 1), F.lower),
        "MONEY": F.regexp_extract_all(t, F.lit(r"(\$[0-9][0-9,]*(?:\.[0-9]+)?(?: (?:million|billion))?)"), 1),
        "DATE": F.filter(F.regexp_extract_all(t, F.lit(rf"\b((?:(?:{MONTH}) [0-9]{{1,2}}, )?(?:19|20)[0-9]{{2}})\b"), 1), is_date),
        "CARDINAL": F.filter(F.regexp_extract_all(t, F.lit(r"(?:^|[ (])([0-9][0-9,]*(?:\.[0-9]+)?) [a-z]"), 1), is_count),
    }
    tagged = lambda kind: lambda x: F.struct(F.lit(kind).alias("type"), x.alias("text"))
    found = F.flatten(F.array(*[F.transform(hits, tagged(kind)) for kind, hits in kinds.items()]))
    return texts.select("id", F.explode(found).alias("e")).select("id", "e.type", "e.text")


def by_type(found: DataFrame) -> DataFrame:
    """(id, total, entities_by_type): counts of each id and a map from type to its different texts in order."""
    each = found.groupBy("id", "type").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("text")).alias("texts"))
    return each.groupBy("id").agg(F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "texts")))).alias("entities_by_type"))
