"""Rules that say how a question is to be answered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPARE = r"(?i)\b(compare|compared|versus|vs|between|differ|difference|than|across|both)\b"
COMPLEX = r"(?i)\b(why|how|explain|reason|cause|impact|affect|trend|relationship|strategy|driver)\b"
SIMPLE = r"(?i)\b(what|which|who|when|where|is|was|does|did)\b"
SIMPLE_WORDS = 12


def detect(questions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, question, companies): companies whose alias is among the question's words; joined by word, not alias by alias."""
    words = questions.select("id", F.explode(F.array_distinct(F.filter(F.split(F.lower("question"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))).alias("alias"))
    found = words.join(aliases.select("alias", "company").distinct(), "alias").groupBy("id").agg(F.sort_array(F.collect_set("company")).alias("companies"))
    return questions.join(found, "id", "left").select("id", "question", F.coalesce("companies", F.array().cast("array<string>")).alias("companies"))


def route(detected: DataFrame) -> DataFrame:
    """(id, kind, confidence, hops, companies): the first rule that holds; where none does, complex at half confidence."""
    n, q = F.size("companies"), F.col("question")
    compares, hard, plain = q.rlike(COMPARE), q.rlike(COMPLEX), q.rlike(SIMPLE)
    words = F.size(F.split(F.trim(F.regexp_replace(q, r"\s+", " ")), " "))
    verdict = lambda kind, sure, hops: F.struct(F.lit(kind).alias("kind"), F.lit(sure).alias("confidence"), F.lit(hops).alias("hops"))
    chosen = (
        F.when(n >= 2, verdict("cross_filing", 0.9, 3))
        .when((n == 1) & compares, verdict("cross_filing", 0.75, 3))
        .when(hard & ~plain, verdict("complex", 0.8, 2))
        .when(plain & (words <= SIMPLE_WORDS) & ~hard, verdict("simple", 0.85, 0))
        .otherwise(verdict("complex", 0.5, 2))
    )
    return detected.select("id", chosen.alias("v"), "companies").select("id", "v.*", "companies")


def decompose(routed: DataFrame, questions: DataFrame) -> DataFrame:
    """(id, part, sub_question): a question over several companies as one for each, up to four; others as they stand."""
    rows = routed.join(questions.select("id", "question"), "id")
    parts = F.when((F.col("kind") == "cross_filing") & (F.size("companies") > 0), F.transform(F.slice("companies", 1, 4), lambda c: F.concat(F.col("question"), F.lit(" ["), c, F.lit("]")))).otherwise(F.array("question"))
    return rows.select("id", F.posexplode(parts).alias("part", "sub_question"))
