"""Search over chunks: by vector, by keyword, both together, and over several hops of a graph.

Chunks are (id, text, ...); a query is a driver-side value, its result a small
ranked table. Scorers that need a model are functions from DataFrame to
DataFrame with a deterministic default.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.functions.text import cosine
from filigree.operators import graph
from filigree.runtime import bound_batches, stage

VECTOR_WEIGHT, KEYWORD_WEIGHT, GRAPH_WEIGHT = 0.7, 0.3, 0.5
HOP_DECAY, KEEP, SEEDS = 0.85, 5, 10


def vector_scores(chunks: DataFrame, vector: DataFrame, least: float | None = None, where: Column | None = None) -> DataFrame:
    """(id, score): cosine of every chunk with ``vector`` (one row, column vector); the payload filter runs first."""
    rows = chunks.where(where) if where is not None else chunks
    scored = rows.where("embedding is not null").join(F.broadcast(vector.select("vector").limit(1))).select("id", cosine(F.col("embedding"), F.col("vector")).alias("score")).where("score is not null")
    return scored if least is None else scored.where(F.col("score") >= least)


def vector_search(chunks: DataFrame, vector: DataFrame, k: int = 20, least: float | None = None, where: Column | None = None) -> DataFrame:
    """The k most similar chunks; a top-k of each task, never a sort of all."""
    return vector_scores(chunks, vector, least, where).orderBy(F.desc("score"), "id").limit(k)


#: Numbers in a block of vectors; each pair of blocks is a row of work.
BLOCK_NUMBERS = 1 << 20


def _blocks(rows: DataFrame, key: str, vector: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(size, name, name_s) with the vectors of a block that have a direction, and (size, name_n) with the number of blocks, by length of vector."""
    rows = rows.where(cosine(F.col(vector), F.col(vector)).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("v"), F.size(vector).alias("size"))
    counts = rows.groupBy("size").agg(F.ceil(F.count("*") * F.col("size") / BLOCK_NUMBERS).alias(f"{name}_n"))
    rows = rows.join(F.broadcast(counts), "size").withColumn(name, F.expr(f"pmod(xxhash64(key), {name}_n)"))
    return rows.groupBy("size", name).agg(F.collect_list(F.struct("key", "v")).alias(f"{name}_s")), counts


def nearest(queries: DataFrame, rows: DataFrame, k: int = 20, least: float | None = None) -> DataFrame:
    """(query, id, score): the k rows (id, embedding) of the highest cosine for each of ``queries`` (query, vector), all rows looked at, ties by id.

    Blocks of queries meet blocks of rows, each pair a task that keeps its best
    k of each query; scores count to twelve places. Vectors of another length
    or without direction are no hits, as for ``vector_scores``.
    """
    bound_batches(rows.sparkSession)
    asked, a = _blocks(queries, "query", "vector", "q")
    held, b = _blocks(rows, "id", "embedding", "r")
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = asked.join(F.broadcast(b), "size").select("size", "q", "q_s", span("r_n").alias("r"))
    right = held.join(F.broadcast(a), "size").select("size", "r", "r_s", span("q_n").alias("q"))
    pairs = left.join(right, ["size", "q", "r"]).select("size", F.col("q_s.key").alias("q"), F.col("q_s.v").alias("qv"), F.col("r_s.key").alias("r"), F.col("r_s.v").alias("rv"))

    def unit(column, i, n):
        v = column[i].values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)
        return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("size")[i].as_py()
                q, r = unit(batch.column("qv"), i, n), unit(batch.column("rv"), i, n)
                for at in range(0, len(q), 512):
                    s = q[at : at + 512] @ r.T
                    floor = np.full((len(s), 1), -2.0 if least is None else least)
                    if len(r) > k and least is None:
                        floor = np.partition(s, -k, axis=1)[:, [-k]]
                    x, y = np.nonzero(s >= floor - 1e-11)
                    if least is not None and len(x) > k * len(s):  # only the queries with more than k hits need a higher bound
                        many = np.flatnonzero(np.bincount(x, minlength=len(s)) > k)
                        floor[many] = np.maximum(floor[many], np.partition(s[many], -k, axis=1)[:, [-k]])
                        x, y = np.nonzero(s >= floor - 1e-11)
                    yield pa.record_batch([batch.column("q")[i].values.take(pa.array(x + at)), batch.column("r")[i].values.take(pa.array(y)), pa.array(np.round(s[x, y], 12))], ["query", "id", "score"])

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    hits = pairs.mapInArrow(search, f"query {kind(queries, 'query')}, id {kind(rows, 'id')}, score double")
    if least is not None:
        hits = hits.where(F.col("score") >= least)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def terms(col: Column) -> Column:
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def postings(chunks: DataFrame) -> DataFrame:
    """(term, id, tf, length): the inverted index; written once and read by term."""
    words = chunks.select("id", terms(F.col("text")).alias("words")).select("id", F.size("words").alias("length"), F.explode("words").alias("term"))
    return words.groupBy("term", "id").agg(F.count("*").alias("tf"), F.first("length").alias("length"))


def keyword_search(index: DataFrame, wanted: list[str], k: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score): BM25, as a share of the best score of the query."""
    docs = index.select("id", "length").distinct().agg(F.count("*").alias("docs"), F.avg("length").alias("mean"))
    hits = index.where(F.col("term").isin([w.lower() for w in wanted]))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    rows = hits.join(df, "term").join(F.broadcast(docs))
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    scored = rows.groupBy("id").agg(F.sum(weight).alias("raw"))
    top = scored.orderBy(F.desc("raw"), "id").limit(k)
    return top.join(F.broadcast(top.agg(F.max("raw").alias("best")))).select("id", (F.col("raw") / F.col("best")).alias("score"))


def keyword_search_each(index: DataFrame, queries: DataFrame, k: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query, id, score): ``keyword_search`` for each of ``queries`` (query, text)."""
    docs = index.select("id", "length").distinct().agg(F.count("*").alias("docs"), F.avg("length").alias("mean"))
    wanted = queries.select("query", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    hits = index.join(wanted.select("term").distinct(), "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    weighed = hits.join(df, "term").join(F.broadcast(docs)).select("term", "id", weight.alias("weight"))
    scored = weighed.join(wanted, "term").groupBy("query", "id").agg(F.sum("weight").alias("raw"))
    order = Window.partitionBy("query").orderBy(F.desc("raw"), "id")
    top = scored.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    return top.select("query", "id", (F.col("raw") / F.max("raw").over(Window.partitionBy("query"))).alias("score"))


def merge_hits(hits: dict[str, DataFrame], weights: dict[str, float]) -> DataFrame:
    """(id, score, sources): scores weighted and summed over the sources that return a chunk, sources in the given order."""
    parts = [df.select("id", (F.col("score") * weights[s]).alias("score"), F.lit(s).alias("source"), F.lit(i).alias("turn")) for i, (s, df) in enumerate(hits.items())]
    rows = reduce(DataFrame.unionByName, parts)
    both = rows.groupBy("id").agg(F.sum("score").alias("score"), F.sort_array(F.collect_list(F.struct("turn", "source"))).alias("s"))
    return both.select("id", "score", F.transform("s", lambda x: x["source"]).alias("sources"))


def keyword_limit(words: int, k: int) -> int:
    return max(10, k // 2) if words >= 3 else min(5, k // 3)


def hybrid(chunks: DataFrame, index: DataFrame, vector: DataFrame, question: str, k: int = 20, rerank: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    words = question.split()
    hits = {"vector": vector_search(chunks, vector, 2 * k), "keyword": keyword_search(index, words, keyword_limit(len(words), k))}
    found = merge_hits(hits, {"vector": VECTOR_WEIGHT, "keyword": KEYWORD_WEIGHT})
    return (rerank(found) if rerank else found).orderBy(F.desc("score"), "id").limit(k)


def lexical_rerank(chunks: DataFrame, question: str) -> Callable[[DataFrame], DataFrame]:
    """A reranker without a model: the share of the question's different words that a chunk holds."""
    wanted = sorted({w.lower() for w in question.split()})

    def rerank(found: DataFrame) -> DataFrame:
        held = F.size(F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, wanted)))) / F.lit(float(max(1, len(wanted))))
        return found.join(chunks.select("id", held.alias("rerank_score")), "id").withColumn("score", F.col("rerank_score"))

    return rerank


def multi_hop(seeds: DataFrame, edges: DataFrame, hops: int = 2, keep: int = KEEP, per_seed: int = 15, total: int = 30, least_weight: float = 0.4) -> DataFrame:
    """(id, score, hop): seeds (id, score) and what lies up to ``hops`` away, the heaviest kept at each hop, scores decaying by hop."""
    edges = stage(edges.select("src", "dst", "weight"), label="hop-edges")
    found = seeds.select("id", "score", F.lit(0).alias("hop")).orderBy(F.desc("score"), "id").limit(SEEDS)
    frontier, visited = found.select("id"), found.select("id")
    for hop in range(1, hops + 1):
        near = stage(graph.expand(frontier, edges, visited, per_seed, total, least_weight), label="hop")
        kept = near.orderBy(F.desc("weight"), "id").limit(keep)
        found = found.unionByName(kept.select("id", (F.col("weight") * HOP_DECAY**hop).alias("score"), F.lit(hop).alias("hop")))
        frontier, visited = kept.select("id"), visited.unionByName(near.select("id"))
    return found


def quota(hits: DataFrame, owner: str, companies: int, whole: int = 10, floor: int = 3) -> DataFrame:
    """At most ``max(floor, whole // companies)`` hits of each owner."""
    most = max(floor, whole // max(1, companies))
    return hits.withColumn("n", F.row_number().over(Window.partitionBy(owner).orderBy(F.desc("score"), "id"))).where(F.col("n") <= most).drop("n")


def in_section(hits: DataFrame, chunks: DataFrame, section: str, k: int) -> DataFrame:
    """The first k hits whose section has the given name, blanks and underscores alike, whatever the case; fetch three times as many before."""
    name = lambda c: F.lower(F.trim(F.regexp_replace(c, "[_ ]+", " ")))
    own = chunks.where(name(F.col("section_item")) == name(F.lit(section))).select("id")
    return hits.join(own, "id", "left_semi").orderBy(F.desc("score"), "id").limit(k)


def allocate(executives: DataFrame, summaries: DataFrame, risks: DataFrame, k: int) -> DataFrame:
    """Rows (content, score, place) of three kinds share k slots: one for executives, up to five for summaries, at least half for risks; in that order."""
    take = {"executive": (executives, 1), "summary": (summaries, min(5, k)), "risk": (risks, max(k - 1 - min(5, k), k // 2))}
    parts = []
    for turn, (kind, (rows, most)) in enumerate(take.items()):
        first = rows.orderBy(F.desc("score"), "content").limit(most)
        parts.append(first.select("content", "score", F.lit(kind).alias("kind"), F.lit(turn).alias("turn")))
    return reduce(DataFrame.unionByName, parts).orderBy("turn", F.desc("score"), "content").limit(k).drop("turn")


def formatted(hits: DataFrame, chunks: DataFrame, chars: int = 300) -> DataFrame:
    """(id, line): each hit with its score and the beginning of its text."""
    text = F.substring(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "), 1, chars)
    return hits.join(chunks.select("id", "text"), "id").select("id", F.format_string("[%s] score=%.3f %s", "id", "score", text).alias("line"))
