"""Graphs as node and edge tables: statistics, components, communities, neighbourhoods."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.runtime import stage

#: Sides of edges whose labels one task settles, about 100 bytes each at their most.
SIDES = 4_000_000


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, loops and repeated ones gone."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
    return edges.select("src", "dst", *rest).unionByName(back).where("src <> dst").dropDuplicates(["src", "dst"])


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree) of all nodes; isolated ones have 0."""
    ends = edges.where("src <> dst").select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the least id that can be reached, by alternating large-star and small-star steps.

    Every step groups by node and links it to its least neighbour, so the
    number of edges never grows and rounds grow with the logarithm of the
    diameter. Rounds are cut by written tables.
    """
    links = stage(edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(), label="links")
    for _ in range(max_rounds):
        # large star: the larger neighbours of a node go to the least of all
        around = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = around.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        down = large.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        least = down.groupBy("hi").agg(F.min("lo").alias("m"))
        small = down.join(least, "hi").select("lo", "hi", "m")
        after = small.select(F.col("m").alias("a"), F.col("hi").alias("b")).unionByName(small.where("lo <> m").select(F.col("m").alias("a"), F.col("lo").alias("b"))).distinct()
        after = stage(after, label="links")
        if after.count() == links.count() and not after.join(links, ["a", "b"], "left_anti").limit(1).count():
            links = after
            break
        links = after
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return nodes.select("id").join(links.select(F.col("b").alias("id"), F.col("a").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("component"))


def _settled(max_rounds: int):
    """Rows (a, b, h, w) of whole components to (n, label), null for what still moves after the last round: the rounds of ``communities`` over arrays.

    After a node's turn only a change around it can move it again, so each
    round looks at the nodes whose turn it is and around which labels changed.
    """

    def work(batches):
        batches = [x for x in batches if x.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        ids, src = np.unique(rows["a"].to_numpy(), return_inverse=True)
        dst = np.searchsorted(ids, rows["b"].to_numpy())
        order = np.lexsort((dst, src))
        first = np.searchsorted(src[order], np.arange(len(ids) + 1))
        dst, w, h = dst[order], rows["w"].to_numpy()[order], rows["h"].to_numpy()[order[first[:-1]]]
        del batches, rows, src, order
        label = np.arange(len(ids))

        def around(some):
            """Places of the sides of these nodes, and whose they are."""
            sizes = first[some + 1] - first[some]
            of = np.repeat(np.arange(len(some)), sizes)
            return np.arange(len(of)) + np.repeat(first[some] - np.cumsum(sizes) + sizes, sizes), of

        def moves(some):
            """Which of these nodes move, and where to."""
            at, of = around(some)
            key = of * len(ids) + label[dst[at]]
            order = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.diff(key[order], prepend=-1))
            votes = np.add.reduceat(w[at[order]], cut)
            who, what = np.divmod(key[order[cut]], len(ids))
            top = np.maximum.reduceat(votes, np.flatnonzero(np.diff(who, prepend=-1)))
            held = np.zeros(len(some))
            own = what == label[some[who]]
            held[who[own]] = votes[own]
            best = np.flatnonzero(votes == top[who])
            best = best[np.diff(who[best], prepend=-1) > 0]  # the least label of equal ones
            go = top > held
            return some[go], what[best[go]]

        waiting, restless = np.ones(len(ids), bool), np.zeros(len(ids), bool)
        for r in range(max_rounds):
            turns = 2 + r // 16
            some = np.flatnonzero(waiting)
            if not len(some):
                break
            some = some[h[some] % turns == r % turns]
            if not len(some):
                continue
            waiting[some] = False
            moved, to = moves(some)
            label[moved] = to
            waiting[dst[around(moved)[0]]] = True
        else:
            some = np.flatnonzero(waiting)
            if len(some):
                restless[moves(some)[0]] = True
        for i in range(0, len(ids), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.record_batch([pa.array(ids[part]), pa.array(ids[label[part]], mask=restless[part])], ["n", "label"])

    return work


def _settled_by_rounds(sides: DataFrame, max_rounds: int) -> DataFrame:
    """The same as ``_settled``, each round a written table, for components that no task may hold."""

    def moves(of: DataFrame, labels: DataFrame) -> DataFrame:
        votes = of.join(labels.withColumnRenamed("n", "b"), "b").groupBy(F.col("a").alias("n"), "label").agg(F.sum("w").alias("w"))
        votes = votes.join(labels.withColumnRenamed("label", "own"), "n")
        best = votes.groupBy("n").agg(F.min_by("label", F.struct((-F.col("w")).alias("w"), F.col("label").alias("l"))).alias("to"), F.max("w").alias("top"), F.max(F.when(F.col("label") == F.col("own"), F.col("w"))).alias("held"))
        return best.where(F.col("top") > F.coalesce("held", F.lit(0.0))).select("n", "to")

    labels = stage(sides.select(F.col("a").alias("n"), F.col("a").alias("label")).distinct(), label="communities")
    for r in range(max_rounds):
        turns = 2 + r // 16
        turn = F.pmod(F.col("h"), F.lit(turns)) == r % turns
        after = labels.join(moves(sides.where(turn), labels), "n", "left").select("n", F.coalesce("to", "label").alias("label"), F.col("to").isNotNull().alias("moved"))
        after = stage(after, label="communities")
        labels = after.drop("moved")
        if not after.where("moved").limit(1).count() and not moves(sides, labels).limit(1).count():
            return labels
    raise RuntimeError(f"communities still change after {max_rounds} rounds")


def communities(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200, most: int = SIDES) -> DataFrame:
    """(id, community) by label propagation over weights until no label changes; a tie goes to the least label, so that runs agree.

    A node keeps its label unless a strictly heavier one surrounds it. Nodes
    take turns, so that neighbours do not swap labels for ever: at first half
    of them at a time, fewer the longer it takes. Edges need a column
    ``weight``. Labels that still change after ``max_rounds`` are an error.

    Components do not touch each other, so tasks work through all rounds of
    the components they hold, up to ``most`` sides (edges in each direction).
    Components beyond that go round by round over all tasks.
    """
    # numbers rise with the ids, as ranges and rows within them do
    ids = nodes.select("id").distinct().repartitionByRange("id").sortWithinPartitions("id")
    ids = stage(ids.select("id", F.monotonically_increasing_id().alias("n"), F.xxhash64("id").alias("h")), label="numbered")
    sides = both_ways(edges.select("src", "dst", F.col("weight").cast("double").alias("w")).where("weight is not null"))
    sides = sides.join(ids.select(F.col("id").alias("src"), F.col("n").alias("a"), "h"), "src").join(ids.select(F.col("id").alias("dst"), F.col("n").alias("b")), "dst")
    sides = stage(sides.select("a", "b", "h", "w"), label="sides")
    work, shape, rows = _settled(max_rounds), "n bigint, label bigint", sides.count()
    if rows <= most:
        labels = sides.repartition(1).mapInArrow(work, shape)
    else:
        found = components(ids.select(F.col("n").alias("id")), sides.where("a < b").select(F.col("a").alias("src"), F.col("b").alias("dst")))
        sides = stage(sides.join(found.withColumnRenamed("id", "a"), "a"), label="sides")
        large = stage(sides.groupBy("component").count().where(F.col("count") > most).select("component"), label="large")
        # an eighth of what a task may hold, as hashes do not spread components evenly
        labels = sides.join(large, "component", "left_anti").repartition(8 * rows // max(1, most) + 1, "component").mapInArrow(work, shape)
        if large.limit(1).count():
            labels = labels.unionByName(_settled_by_rounds(stage(sides.join(large, "component", "left_semi"), label="sides"), max_rounds))
    labels = stage(labels, label="communities")
    if labels.where("label is null").limit(1).count():
        raise RuntimeError(f"communities still change after {max_rounds} rounds")
    out = ids.select("id", "n").join(labels, "n", "left").select("id", F.coalesce("label", "n").alias("label"))
    return out.join(ids.select(F.col("n").alias("label"), F.col("id").alias("community")), "label").select("id", "community")


def statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(nodes, edges, average_degree, max_degree, isolated) in one row."""
    d = degrees(nodes, edges)
    n = edges.where("src <> dst").select(F.least("src", "dst"), F.greatest("src", "dst")).distinct().agg(F.count("*").alias("edges"))
    return d.agg(F.count("*").alias("nodes"), F.round(F.avg("degree"), 6).alias("average_degree"), F.max("degree").alias("max_degree"), F.count_if(F.col("degree") == 0).alias("isolated")).join(n)


def expand(frontier: DataFrame, edges: DataFrame, visited: DataFrame, per_seed: int = 15, total: int = 30, least_weight: float = 0.4) -> DataFrame:
    """(id, weight, seed): unvisited neighbours of the frontier (id), the heaviest edges of each seed, each neighbour once, the heaviest of all."""
    near = frontier.select(F.col("id").alias("src")).join(both_ways(edges.select("src", "dst", "weight")), "src").where(F.col("weight") >= least_weight)
    near = near.join(visited.select(F.col("id").alias("dst")), "dst", "left_anti")
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("weight"), "dst"))).where(F.col("n") <= per_seed)
    best = ranked.groupBy(F.col("dst").alias("id")).agg(F.max("weight").alias("weight"), F.min_by("src", F.struct(-F.col("weight"), F.col("src"))).alias("seed"))
    return best.orderBy(F.desc("weight"), "id").limit(total)


def community_relations(labels: DataFrame, edges: DataFrame, most: int = 200) -> DataFrame:
    """(community, type, n): edges within each community by type, the ``most`` frequent of each."""
    a, b = labels.withColumnsRenamed({"id": "src", "community": "c"}), labels.withColumnsRenamed({"id": "dst", "community": "d"})
    inside = edges.join(a, "src").join(b, "dst").where("c = d").groupBy(F.col("c").alias("community"), "type").agg(F.count("*").alias("n"))
    order = Window.partitionBy("community").orderBy(F.desc("n"), "type")
    return inside.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")


def match_path(nodes: DataFrame, edges: DataFrame, labels: list[str], types: list[str]) -> DataFrame:
    """(n0, n1, ...): paths whose nodes have the given labels, joined by edges of the given types, one fewer than the labels."""
    if len(types) != len(labels) - 1:
        raise ValueError("one type for each step")
    out = nodes.where(F.col("label") == labels[0]).select(F.col("id").alias("n0"))
    for i, (label, kind) in enumerate(zip(labels[1:], types)):
        step = edges.where(F.col("type") == kind).select(F.col("src").alias(f"n{i}"), F.col("dst").alias(f"n{i + 1}"))
        ends = nodes.where(F.col("label") == label).select(F.col("id").alias(f"n{i + 1}"))
        out = out.join(step, f"n{i}").join(ends, f"n{i + 1}")
    return out.select(*[f"n{i}" for i in range(len(labels))])
