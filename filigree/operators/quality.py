"""Data-quality rules: each gives rows (accession_number, issue_type, severity, field, actual); one table holds them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LATE_DAYS = 120
CEILING = 10**15
BALANCE_TOLERANCE, BALANCE_ERROR = 0.01, 0.05
SHORT_WORDS = 100


def _issue(rows: DataFrame, kind: str, severity: Column | str, field: str, actual: Column) -> DataFrame:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return rows.select("accession_number", F.lit(kind).alias("issue_type"), level.alias("severity"), F.lit(field).alias("field"), actual.cast("string").alias("actual"))


def filing_dates(filings: DataFrame) -> DataFrame:
    """Annual reports filed late, and periods that end after the filing."""
    days = F.datediff("filing_date", "period_of_report")
    late = _issue(filings.where((F.col("form_type") == "10-K") & (days > LATE_DAYS)), "late_filing", "warning", "filing_date", days)
    early = _issue(filings.where(days < 0), "validation_error", "error", "period_of_report", days)
    return late.unionByName(early)


def fact_rules(facts: DataFrame) -> DataFrame:
    """Facts without content, with impossible values, names or periods."""
    rules = {
        "no_value": F.col("value").isNull() & F.col("value_text").isNull(),
        "value_too_large": F.abs("value") > CEILING,
        "blank_concept": F.coalesce(F.trim("concept_name"), F.lit("")) == "",
        "period_reversed": (F.col("period_type") == "duration") & (F.col("period_start") > F.col("period_end")),
        "period_type": ~F.coalesce(F.col("period_type").isin("instant", "duration", "forever"), F.lit(False)),
    }
    found = F.filter(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    rows = facts.select("accession_number", F.explode(found).alias("kind"))
    return rows.select("accession_number", F.col("kind").alias("issue_type"), F.lit("warning").alias("severity"), F.lit("fact").alias("field"), F.lit(None).cast("string").alias("actual"))


def required_concepts(filings: DataFrame, facts: DataFrame, required: list[str]) -> DataFrame:
    """Filings that lack a required concept."""
    wanted = filings.select("accession_number", F.explode(F.array(*map(F.lit, required))).alias("concept_name"))
    missing = wanted.join(facts.where(F.col("concept_name").isin(required)).select("accession_number", "concept_name"), ["accession_number", "concept_name"], "left_anti")
    return _issue(missing, "missing_concept", "warning", "concept_name", F.col("concept_name"))


def balance(facts: DataFrame, assets: list[str], liabilities: list[str], equity: list[str]) -> DataFrame:
    """Assets against liabilities and equity; each side takes the first listed concept that has a latest value without dimensions."""
    order = {c: (part, i) for part, names in (("a", assets), ("l", liabilities), ("e", equity)) for i, c in enumerate(names)}
    held = F.create_map(*[x for c, (part, i) in order.items() for x in (F.lit(c), F.struct(F.lit(part).alias("part"), F.lit(i).alias("rank")))])
    rows = facts.where(F.col("concept_name").isin(*order) & (F.coalesce(F.size("dimensions"), F.lit(0)) <= 0))
    last = Window.partitionBy("accession_number", "concept_name").orderBy(F.col("period_end").desc_nulls_last(), "id")
    rows = rows.withColumn("n", F.row_number().over(last)).where("n = 1 and value is not null").withColumn("at", held[F.col("concept_name")])
    best = rows.groupBy("accession_number").agg(*[F.min_by(F.when(F.col("at.part") == p, F.col("value").cast("double")), F.when(F.col("at.part") == p, F.col("at.rank"))).alias(p) for p in "ale"])
    other = F.coalesce("l", F.lit(0.0)) + F.coalesce("e", F.lit(0.0))
    gap = F.abs(F.col("a") - other) / F.abs("a")
    usable = best.where("a is not null and a <> 0 and (l is not null or e is not null) and (l is null or l <> a)")
    return _issue(usable.where(gap > BALANCE_TOLERANCE), "balance", F.when(gap < BALANCE_ERROR, "warning").otherwise("error"), "assets", F.round(gap, 4))


def negative_values(facts: DataFrame, positive: list[str]) -> DataFrame:
    rows = facts.where(F.col("concept_name").isin(positive) & (F.col("value") < 0) & ~F.coalesce("is_negated", F.lit(False)))
    return _issue(rows, "negative_value", "warning", "value", F.col("concept_name"))


def duplicate_facts(facts: DataFrame) -> DataFrame:
    """One issue for each filing with repeated facts, with the number of extras."""
    dims = F.when(F.coalesce(F.size("dimensions"), F.lit(-1)) >= 0, F.to_json(F.array_sort(F.map_entries("dimensions"))))
    n = facts.groupBy("accession_number", "concept_name", "period_start", "period_end", dims.alias("dims")).agg(F.count("*").alias("n"))
    extras = n.groupBy("accession_number").agg(F.sum(F.col("n") - 1).alias("extras")).where("extras > 0")
    return _issue(extras, "duplicate_facts", "warning", "facts", F.col("extras"))


def completeness(facts: DataFrame, low: int, high: int) -> DataFrame:
    n = facts.groupBy("accession_number").agg(F.count("*").alias("n")).where(~F.col("n").between(low, high))
    return _issue(n, "fact_count", "warning", "facts", F.col("n"))


def section_rules(sections: DataFrame, words: Column, required: list[str]) -> DataFrame:
    """Sections of few words (none is not few), and filings whose sections lack a required item."""
    counted = sections.withColumn("_words", words)
    short = _issue(counted.where((F.col("_words") > 0) & (F.col("_words") < SHORT_WORDS)), "short_section", "warning", "markdown", F.col("_words"))
    wanted = sections.select("accession_number").distinct().select("accession_number", F.explode(F.array(*map(F.lit, required))).alias("item"))
    missing = wanted.join(sections.select("accession_number", "item"), ["accession_number", "item"], "left_anti")
    return short.unionByName(_issue(missing, "missing_section", "warning", "item", F.col("item")))


def verdict(issues: list[DataFrame], strict: bool = False) -> DataFrame:
    """(accession_number, errors, warnings, valid): strict counts warnings as errors."""
    rows = reduce(DataFrame.unionByName, issues)
    counts = rows.groupBy("accession_number").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    bad = F.col("errors") + (F.col("warnings") if strict else F.lit(0))
    return counts.withColumn("valid", bad == 0)
