"""The most similar vectors of every vector, by multiprobe p-stable hashing.

Vectors are brought to unit length, where the order by cosine is the order by
distance. A table has ``m`` functions floor((a.x + b) / w) with normal a; the
functions' values name the bucket, those of the first few the cell. A query
visits its own bucket and ``probes - 1`` perturbed ones in the order of their
estimated success: the sets of smallest expected sum of squared distances to
the boundaries crossed, worked out once over the ranks of the distances and
read for each query in the order of its own distances. All buckets of a cell
lie in one task, so a query travels once for each cell that its probes touch,
not once for each probe. Candidates of all tables are ranked by exact cosine.

``m`` follows from the number of vectors, so that buckets hold about
``bucket_rows`` at every size, and probes double with each function after the
sixth. Equal vectors are one entry. A cell of more than ``cell_rows`` entries
is cut into blocks, and every block of its queries meets every block of its
entries in a task of its own; nothing is dropped.

Defined results: vectors that are null, hold a null, NaN or infinity, are all
zero or of another length than ``dim`` take no part; a repeated id counts
once, with the vector of the smallest hash; equal cosines rank by id; fewer than k
others give fewer neighbours.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.runtime import bound_batches, stage

#: Bytes of the keys that a worker works out at once, rows it searches together, and vectors that are compared with all others at once.
PROBE_BYTES, ROWS_AT_ONCE, LACKING_ROWS = 16 << 20, 100_000, 10_000
VALUES_PER_FUNCTION = 3.9  # different values of one function at width 1.2 on unit vectors, as measured


def probing_order(m: int, width: float, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets over the ranks 0..2m-1 of the boundary distances, by expected score; the empty set first."""
    n = 2 * m
    # expected squares of the ordered distances of a point to the two boundaries of m functions
    up = [(j * (j + 1)) / (4 * (m + 1) * (m + 2)) * width**2 for j in range(1, m + 1)]
    score = up + [(1 - (n + 1 - j) / (m + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (m + 1) * (m + 2))) * width**2 for j in range(m + 1, n + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(score[0], (0,))]
    while heap and len(out) < probes:
        total, ranks = heapq.heappop(heap)
        if not any(n - 1 - r in ranks for r in ranks):  # both sides of one function cannot be crossed
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < n:
            heapq.heappush(heap, (total + score[last + 1], (*ranks, last + 1)))
            heapq.heappush(heap, (total - score[last] + score[last + 1], (*ranks[:-1], last + 1)))
    return out


@dataclass(frozen=True)
class Tables:
    dim: int
    tables: int
    functions: int
    coarse: int
    width: float
    probes: int
    seed: int

    def make(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(a, b, multipliers of the bucket key, multipliers of the cell key) of each table."""
        rng = np.random.default_rng(self.seed)
        out = []
        for _ in range(self.tables):
            a = rng.standard_normal((self.dim, self.functions)).astype(np.float32)
            b = (rng.random(self.functions) * self.width).astype(np.float32)
            fine = rng.integers(-(1 << 62), 1 << 62, self.functions) | 1
            cell = (rng.integers(-(1 << 62), 1 << 62, self.functions) | 1) * (np.arange(self.functions) < self.coarse)
            out.append((a, b, fine, cell))
        return out

    def sets(self) -> np.ndarray:
        ranks = probing_order(self.functions, self.width, self.probes)
        out = np.zeros((len(ranks), 2 * self.functions), np.int64)
        for i, s in enumerate(ranks):
            out[i, list(s)] = 1
        return out


def visited(x: np.ndarray, table, width: float, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket keys, cell keys) that each vector visits, n x probes; the first is its own."""
    a, b, fine, cell = table
    m = len(b)
    p = (x @ a + b) / np.float32(width)
    h = np.floor(p)
    f = p - h
    h = h.astype(np.int64)
    order = np.argsort(np.concatenate((f, 1 - f), axis=1), axis=1, kind="stable")
    which, step = order % m, np.where(order < m, -1, 1)
    keys = (h @ fine)[:, None] + (step * fine[which]) @ sets.T
    cells = (h @ cell)[:, None] + (step * cell[which]) @ sets.T
    return keys, cells


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    raw = b"".join(batch.column("vector").to_pylist())
    return np.frombuffer(raw, np.float32).reshape(-1, dim)


def _to_bytes(dim: int):
    def work(batches):
        for b in batches:
            x = np.array(b.column("vector").to_pylist(), np.float64).reshape(-1, dim)
            x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
            x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
            yield pa.record_batch([b.column("class"), pa.array([r.tobytes() for r in x], pa.binary())], ["class", "vector"])

    return work


def _home_counts(t: Tables):
    def work(batches):
        tables, sets = t.make(), t.sets()[:1]
        for b in batches:
            x = _vectors(b, t.dim)
            for n, table in enumerate(tables):
                cells, counts = np.unique(visited(x, table, t.width, sets)[1][:, 0], return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(cells), n), pa.int64()), pa.array(cells), pa.array(counts, pa.int64())], ["table", "cell", "n"])

    return work


def _scatter(t: Tables, hot: dict[tuple[int, int], int]):
    """Rows (table, cell, s, u, entry, query, class, vector): block s of the cell's entries meets block u of its queries."""

    crowded = []
    for n in range(t.tables):
        cells = sorted((c, size) for (table, c), size in hot.items() if table == n)
        crowded.append((np.array([c for c, _ in cells], np.int64), np.array([size for _, size in cells], np.int64)))

    def work(batches):
        tables, sets = t.make(), t.sets()
        step = max(1, PROBE_BYTES // (8 * len(sets)))
        for b in (whole.slice(lo, step) for whole in batches for lo in range(0, whole.num_rows, step)):
            x = _vectors(b, t.dim)
            cls = b.column("class").to_numpy()
            spread = (cls.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for n, table in enumerate(tables):
                cells = visited(x, table, t.width, sets)[1]
                home = cells[:, 0].copy()
                cells = np.sort(cells, axis=1)
                new = np.ones(cells.shape, bool)
                new[:, 1:] = cells[:, 1:] != cells[:, :-1]
                row, col = np.nonzero(new)
                cell = cells[row, col]
                own = cell == home[row]
                blocks = np.ones(len(row), np.int64)
                if len(names := crowded[n][0]):
                    j = np.minimum(np.searchsorted(names, cell), len(names) - 1)
                    blocks = np.where(names[j] == cell, crowded[n][1][j], 1)
                mine = (spread[row] % blocks.astype(np.uint64)).astype(np.int64)
                plain = np.flatnonzero(blocks == 1)
                parts = [(row[plain], cell[plain], mine[plain], mine[plain], own[plain], np.ones(len(plain), bool))]
                # where blocks are many, a query goes to all blocks of entries and an entry to all blocks of queries
                many = np.repeat(np.flatnonzero(blocks > 1), blocks[blocks > 1])
                if len(many):
                    k = np.arange(len(many)) - np.repeat(np.cumsum(blocks[blocks > 1]) - blocks[blocks > 1], blocks[blocks > 1])
                    here = k == mine[many]
                    parts.append((row[many], cell[many], k, mine[many], here & own[many], np.ones(len(many), bool)))
                    else_ = many[~here & own[many]]
                    parts.append((row[else_], cell[else_], mine[else_], k[~here & own[many]], np.ones(len(else_), bool), np.zeros(len(else_), bool)))
                row, cell, s, u, entry, query = (np.concatenate(v) for v in zip(*parts))
                yield pa.record_batch(
                    [pa.array(np.full(len(row), n), pa.int64()), pa.array(cell), pa.array(s), pa.array(u), pa.array(entry), pa.array(query), pa.array(cls[row]), b.column("vector").take(pa.array(row))],
                    ["table", "cell", "s", "u", "entry", "query", "class", "vector"],
                )

    return work


def nearest(x: np.ndarray, cls: np.ndarray, at: np.ndarray, mine: np.ndarray, visits: np.ndarray, home: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, candidates n x k, cosines n x k) of the queries ``at`` of one task among its entries ``mine``; -2 where there are fewer than k.

    ``visits`` are the bucket keys that the queries visit, ``home`` the buckets of the entries.
    """
    best = np.full((len(at), k), -2, np.float32)
    who = np.full((len(at), k), -1, np.int64)
    order = np.argsort(home, kind="stable")
    mine = mine[order]
    buckets, first = np.unique(home[order], return_index=True)
    ends = np.append(first[1:], len(mine))
    j = np.minimum(np.searchsorted(buckets, visits), len(buckets) - 1) if len(buckets) else np.zeros(visits.shape, np.int64)
    hit = buckets[j] == visits if len(buckets) else np.zeros(visits.shape, bool)
    q, col = np.nonzero(hit)
    bucket = j[q, col]
    by = np.argsort(bucket, kind="stable")
    q, bucket = q[by], bucket[by]
    edges = np.searchsorted(bucket, np.arange(len(buckets) + 1))
    for b in range(len(buckets)):
        rows = mine[first[b] : ends[b]]
        for lo in range(edges[b], edges[b + 1], 4096):
            asked = q[lo : min(lo + 4096, edges[b + 1])]
            for part in range(0, len(rows), 4096):
                some = rows[part : part + 4096]
                cosine = x[at[asked]] @ x[some].T
                cosine[cls[at[asked]][:, None] == cls[some][None, :]] = -2
                better = (cosine > best[asked, -1][:, None]).any(axis=1)
                if not better.any():
                    continue
                who_asked = asked[better]
                both = np.concatenate((best[who_asked], cosine[better]), axis=1)
                names = np.concatenate((who[who_asked], np.broadcast_to(cls[some], (len(who_asked), len(some)))), axis=1)
                top = np.argsort(-both, axis=1, kind="stable")[:, :k] if both.shape[1] <= 64 else np.argpartition(-both, k - 1, axis=1)[:, :k]
                best[who_asked], who[who_asked] = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
                down = np.argsort(-best[who_asked], axis=1, kind="stable")
                best[who_asked], who[who_asked] = np.take_along_axis(best[who_asked], down, 1), np.take_along_axis(who[who_asked], down, 1)
    return cls[at], who, best


def _search(t: Tables, k: int):
    """Rows of ``_scatter``, sorted by task, to (class, other, cosine); whole tasks at a time."""

    def searched(rows: pa.Table, tables, sets):
        number, cell, s, u, entry, query, cls = (rows.column(c).to_numpy() for c in ("table", "cell", "s", "u", "entry", "query", "class"))
        x = np.frombuffer(b"".join(v for chunk in rows.column("vector").chunks for v in chunk.to_pylist()), np.float32).reshape(-1, t.dim)
        for a, z in zip(*_tasks(number, cell, s, u)):
            mine, at = np.flatnonzero(entry[a:z]) + a, np.flatnonzero(query[a:z]) + a
            if not len(mine):
                continue
            home = visited(x[mine], tables[number[a]], t.width, sets[:1])[0][:, 0]
            for part in np.array_split(at, -(-len(at) * len(sets) * 8 // PROBE_BYTES) or 1):
                keys, cells = visited(x[part], tables[number[a]], t.width, sets)
                # a bucket of another cell is not here; -1 as the key would be found by no entry
                keys[cells != cell[a]] = np.int64(-(1 << 63))
                who, found, cosine = nearest(x, cls, part, mine, keys, home, k)
                r, c = np.nonzero(cosine > -2)
                yield pa.record_batch([pa.array(who[r]), pa.array(found[r, c]), pa.array(cosine[r, c])], ["class", "other", "cosine"])

    def work(batches):
        tables, sets = t.make(), t.sets()
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size < ROWS_AT_ONCE:
                continue
            rows = pa.Table.from_batches(held)
            # the last task may go on in the next batch
            cut = _tasks(*(rows.column(c).to_numpy() for c in ("table", "cell", "s", "u")))[0][-1]
            if cut:
                yield from searched(rows.slice(0, cut), tables, sets)
                rows = rows.slice(cut)
            held, size = rows.combine_chunks().to_batches(), rows.num_rows
        if held:
            yield from searched(pa.Table.from_batches(held), tables, sets)

    return work


def _tasks(*names: np.ndarray) -> tuple[list[int], list[int]]:
    """Where tasks begin and end in sorted rows."""
    n = len(names[0])
    edge = np.flatnonzero(np.concatenate(([n > 0], np.any([np.diff(v) != 0 for v in names], axis=0), [n > 0]))).tolist() if n else [0]
    return edge[:-1], edge[1:]


def _against_all(of: np.ndarray, asked: np.ndarray, dim: int, k: int):
    """Rows (class, vector) to the k most similar of each part of them to each of the vectors asked for."""

    def work(batches):
        best, who = np.full((len(of), k), -2, np.float32), np.full((len(of), k), -1, np.int64)
        for b in batches:
            x, cls = _vectors(b, dim), b.column("class").to_numpy()
            for lo in range(0, len(of), 1024):
                part = slice(lo, lo + 1024)
                cosine = asked[part] @ x.T
                cosine[of[part, None] == cls[None, :]] = -2
                both, names = np.concatenate((best[part], cosine), axis=1), np.concatenate((who[part], np.broadcast_to(cls, cosine.shape)), axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best[part], who[part] = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
        r, c = np.nonzero(best > -2)
        yield pa.record_batch([pa.array(of[r]), pa.array(who[r, c]), pa.array(best[r, c])], ["class", "other", "cosine"])

    return work


def neighbours(
    df: DataFrame, key: str, vector: str, k: int = 5, dim: int | None = None, tables: int = 3, width: float = 1.2, probes: int = 64, bucket_rows: int = 15, cell_rows: int = 50_000, seed: int = 7
) -> DataFrame:
    """(key, other, cosine, rank): the k most similar others of every usable vector."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("vector")).where("key is not null and vector is not null and size(vector) > 0")
    if dim is None:
        common = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
        dim = common["dim"] if common else 1
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where((F.size("vector") == dim) & ~bad & F.exists("vector", lambda v: v != 0))
    rows = rows.withColumn("class", F.xxhash64("vector"))
    members = stage(rows.groupBy("key").agg(F.min("class").alias("class")), label="vector-classes")
    # grouped by class as the members' classes are joined, so that vectors move once
    unit = rows.groupBy("class").agg(F.first("vector").alias("vector")).join(members.select("class").distinct(), "class", "left_semi")
    unit = stage(unit.mapInArrow(_to_bytes(dim), "class bigint, vector binary"), label="unit-vectors")
    n = unit.count()
    per = log(VALUES_PER_FUNCTION)
    m = max(2, round(log(max(2, n / bucket_rows)) / per))
    coarse = min(m, max(1, int(log(max(1.1, n / 6000)) / per)))
    t = Tables(dim, tables, m, coarse, width, max(probes, 2**m), seed)
    crowded = unit.mapInArrow(_home_counts(t), "table bigint, cell bigint, n bigint").groupBy("table", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > cell_rows)
    # no more than tables * n / cell_rows lines
    hot = {(r.table, r.cell): -(-r.n // cell_rows) for r in crowded.collect()}
    sent = unit.mapInArrow(_scatter(t, hot), "table bigint, cell bigint, s bigint, u bigint, entry boolean, query boolean, class bigint, vector binary")
    tasks = sent.repartition("table", "cell", "s", "u").sortWithinPartitions("table", "cell", "s", "u")
    found = stage(tasks.mapInArrow(_search(t, k), "class bigint, other bigint, cosine float"), label="similar-vectors")
    # vectors whose probes met too few others are compared with all, some at a time
    enough = found.groupBy("class").agg(F.countDistinct("other").alias("n")).where(F.col("n") >= min(k, n - 1)).select("class")
    lacking = stage(unit.join(enough, "class", "left_anti"), label="lonely-vectors") if n > 1 else unit.limit(0)
    lonely = lacking.count()
    lots = -(-lonely // LACKING_ROWS)
    for lot in range(lots):
        few = lacking.where(F.pmod(F.xxhash64("class", F.lit(3)), F.lit(lots)) == lot).select("class", "vector").toArrow()
        of, asked = few.column("class").to_numpy(), np.frombuffer(b"".join(few.column("vector").to_pylist()), np.float32).reshape(-1, dim)
        found = found.unionByName(unit.mapInArrow(_against_all(of, asked, dim, k), "class bigint, other bigint, cosine float"))
    once = found.repartition("class").groupBy("class", "other").agg(F.max("cosine").alias("cosine"))
    best = once.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("cosine"), "other"))).where(F.col("r") <= k).drop("r")
    # of a class only its k + 1 smallest keys can be anyone's neighbour
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("key"))).where(F.col("r") <= k + 1).drop("r")
    of_others = best.join(few.select(F.col("class").alias("other"), F.col("key").alias("name")), "other").select("class", "name", F.col("cosine").cast("double").alias("cosine"))
    of_own = few.select("class", F.col("key").alias("name"), F.lit(1.0).alias("cosine"))
    listed = of_others.unionByName(of_own).withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("cosine"), "name"))).where(F.col("r") <= k + 1)
    out = members.join(listed, "class").where("key <> name")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("cosine"), "name"))
    return out.select("key", F.col("name").alias("other"), "cosine", rank.alias("rank")).where(F.col("rank") <= k)
