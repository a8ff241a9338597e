"""The passage graph: chunks joined along a filing, across sections, by entities and over years.

Nodes have (id, filing, owner, year, section, position). Edges are undirected,
src < dst, with a type and a weight; where two builders join the same pair,
the stronger type stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WEIGHTS = {"sequential": 0.8, "section_head": 0.5, "entity": 0.6, "temporal": 0.7}
#: Which type stays where builders meet, the first before the next.
PRECEDENCE = ["temporal", "entity", "sequential", "section_head", "similar"]
YEAR_GAP = 2
PER_FILING, NEXT_FILINGS = 5, 5


def _edges(rows: DataFrame, a: str, b: str, kind: str) -> DataFrame:
    return rows.where(f"{a} <> {b}").select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"), F.lit(kind).alias("type"), F.lit(WEIGHTS[kind]).alias("weight")).distinct()


def sequential(nodes: DataFrame) -> DataFrame:
    order = Window.partitionBy("filing", "section").orderBy("position", "id")
    return _edges(nodes.withColumn("next", F.lead("id").over(order)).where("next is not null"), "id", "next", "sequential")


def section_heads(nodes: DataFrame) -> DataFrame:
    """First chunks of the sections of a filing, each with each; a filing has a few dozen sections at most."""
    first = nodes.withColumn("n", F.row_number().over(Window.partitionBy("filing", "section").orderBy("position", "id"))).where("n = 1")
    other = first.select("filing", F.col("id").alias("other"))
    return _edges(first.select("filing", "id").join(other, "filing").where("id < other"), "id", "other", "section_head")


def temporal(nodes: DataFrame) -> DataFrame:
    """The same place of the same section in the owner's next year that has it, at most two years on."""
    order = Window.partitionBy("owner", "section", "year").orderBy("filing", "position", "id")
    placed = nodes.where("owner is not null and year is not null").withColumn("place", F.row_number().over(order))
    years = placed.select("owner", "section", "year").distinct()
    years = years.withColumn("next", F.lead("year").over(Window.partitionBy("owner", "section").orderBy("year"))).where(F.col("next") - F.col("year") <= YEAR_GAP)
    later = placed.select("owner", "section", F.col("year").alias("next"), "place", F.col("id").alias("other"))
    return _edges(placed.join(years, ["owner", "section", "year"]).join(later, ["owner", "section", "next", "place"]), "id", "other", "temporal")


def mentions(nodes: DataFrame, texts: DataFrame, names: DataFrame) -> DataFrame:
    """(id, entity): chunks (id, text) that hold a name (entity, name) of another owner. Joined on the name's first word, never name by name."""
    firsts = names.where("name is not null and entity is not null").select("entity", F.lower("name").alias("name")).where("length(name) > 3").distinct()
    firsts = firsts.withColumn("word", F.regexp_extract("name", r"^([\p{L}\p{N}]+)", 1)).where("word <> ''")
    words = texts.select("id", F.lower("text").alias("text")).select("id", "text", F.explode(F.array_distinct(F.split("text", r"[^\p{L}\p{N}]+"))).alias("word"))
    found = words.select("id", "word").join(firsts, "word").join(texts.select("id", F.lower("text").alias("text")), "id").where(F.col("text").contains(F.col("name")))
    return found.join(nodes.select("id", "owner"), "id").where("owner is null or owner <> entity").select("id", "entity").distinct()


def cooccurrence(nodes: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Chunks of different filings that mention one entity: the first of each filing with those of the next filings that mention it.

    Each chunk gets at most ``PER_FILING * NEXT_FILINGS`` edges an entity on
    either side, so that an entity which all filings mention costs no more
    than the chunks it has.
    """
    rows = mentioned.join(nodes.select("id", "filing", "section", "position"), "id")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("entity", "filing").orderBy("section", "position", "id"))).where(F.col("n") <= PER_FILING)
    order = first.select("entity", "filing").distinct().withColumn("turn", F.row_number().over(Window.partitionBy("entity").orderBy("filing")))
    first = first.join(order, ["entity", "filing"]).select("entity", "id", "turn")
    ahead = first.select("entity", "id", F.explode(F.expr(f"sequence(turn + 1, turn + {NEXT_FILINGS})")).alias("turn"))
    return _edges(ahead.join(first.withColumnRenamed("id", "other"), ["entity", "turn"]), "id", "other", "entity")


def merged(parts: list[DataFrame]) -> DataFrame:
    """One edge a pair, of the strongest type."""
    rank = reduce(lambda w, x: w.when(F.col("type") == x[1], x[0]), enumerate(PRECEDENCE[1:], 1), F.when(F.col("type") == PRECEDENCE[0], 0))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("src", "dst").agg(F.min_by("type", rank).alias("type"), F.min_by("weight", rank).alias("weight"))


def similar(links: DataFrame, nodes: DataFrame, existing: DataFrame, least: float = 0.60, keep: int = 10) -> DataFrame:
    """Edges of weight 0.9 x score from scored links (id, target, score): known targets, no loops, no pair that has an edge, and among the best ``keep`` of either end."""
    ids = nodes.select("id")
    rows = links.where((F.col("score") >= least) & (F.col("id") != F.col("target"))).join(ids, "id", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    rows = rows.select(F.least("id", "target").alias("src"), F.greatest("id", "target").alias("dst"), "score").groupBy("src", "dst").agg((F.max("score") * 0.9).alias("weight"))
    rows = rows.join(existing.select("src", "dst"), ["src", "dst"], "left_anti")
    ends = rows.select("src", "dst", "weight", F.explode(F.array("src", "dst")).alias("end"))
    order = Window.partitionBy("end").orderBy(F.desc("weight"), "src", "dst")
    return ends.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep).select("src", "dst", F.lit("similar").alias("type"), "weight").distinct()
