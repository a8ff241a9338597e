"""Filling fixed-capacity containers with texts, little room unused.

Lengths are whole numbers up to the capacity, so what the packer needs of a
corpus of any size is the number of texts of each length. Hierarchical
multi-length packing works on that histogram:

* texts are routed to tiers (capacity, half of it, a quarter, ...) by length;
* windows are opened from the longest tier that has texts left, and the gap
  of a window is filled from the same and then from shorter tiers, always with
  the longest text that fits, as many windows at once as the counts allow;
* windows are numbered from full to empty and dealt to step groups to and fro,
  so that the groups of one size hold about the same number of tokens.

The plan is a list of runs (length, ranks from-to, container of the first).
A text finds its place by its rank among the texts of its length, which is the
sum of the counts of earlier partitions and its rank within its own; so a
length that a third of all texts share is never sorted in one task.

The plan is bounded by the capacity alone: every window pattern uses up at
least one length, so there are at most C patterns, and a pattern of d different
lengths needs d(d+1)/2 <= C tokens, so at most C * sqrt(2C) runs.

Defined results: a text of 0 tokens (null, empty) is kept with a null
container; a text over the capacity is cut into full containers and one rest
that is packed like a text; repeated keys are packed row by row.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.llm.tokens import DEFAULT_VOCABULARY, token_counts
from filigree.runtime import stage

STEP_WINDOWS = 32


@dataclass(frozen=True)
class Spec:
    name: str
    capacity: int
    separator: int = 0


@dataclass(frozen=True)
class Run:
    """``count`` texts of ``length`` from ``rank`` on: ``copies`` in each container from ``container`` on, from ``slot`` and ``offset`` on."""

    length: int
    rank: int
    count: int
    container: int
    copies: int
    slot: int
    offset: int


@dataclass(frozen=True)
class Plan:
    runs: list[Run]
    containers: int
    unused: int


def tiers(capacity: int, least: int = 64) -> list[int]:
    """Upper bounds of the tiers, long to short."""
    out = [capacity]
    while out[-1] // 2 >= least:
        out.append(out[-1] // 2)
    return out


def plan(counts: dict[int, int], spec: Spec) -> Plan:
    """Pack texts of 1..capacity tokens, given how many there are of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= spec.capacity for n in left):
        raise ValueError("lengths must lie within the capacity")
    bounds = tiers(spec.capacity)
    # each tier's lengths in ascending order; a text of a tier is longer than the next tier's bound
    shelf = [sorted(n for n in left if lower < n <= upper) for upper, lower in zip(bounds, [*bounds[1:], 0])]
    ranks = dict.fromkeys(left, 0)
    patterns: list[tuple[int, int, list[tuple[int, int]]]] = []  # (unused, windows, [(length, copies)])
    for top in range(len(shelf)):
        while shelf[top]:
            parts: list[tuple[int, int]] = []
            room = spec.capacity + spec.separator
            for level in range(top, len(shelf)):
                lengths = shelf[level]
                at = bisect.bisect_right(lengths, room - spec.separator) - 1
                while at >= 0:
                    size = lengths[at]
                    copies = min(left[size], room // (size + spec.separator))
                    parts.append((size, copies))
                    room -= copies * (size + spec.separator)
                    at = min(at - 1, bisect.bisect_right(lengths, room - spec.separator) - 1)
            windows = min(left[size] // copies for size, copies in parts)
            for size, copies in parts:
                left[size] -= windows * copies
                if not left[size]:
                    for lengths in shelf:
                        at = bisect.bisect_left(lengths, size)
                        if at < len(lengths) and lengths[at] == size:
                            del lengths[at]
            patterns.append((room, windows, parts))
    patterns.sort(key=lambda p: p[0])
    runs, container, unused = [], 0, 0
    for room, windows, parts in patterns:
        slot = offset = 0
        for size, copies in parts:
            runs.append(Run(size, ranks[size], windows * copies, container, copies, slot, offset))
            ranks[size] += windows * copies
            slot += copies
            offset += copies * (size + spec.separator)
        container += windows
        unused += windows * room
    return Plan(runs, container, unused)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Rank of each piece among those of its spec and length, without sorting a length in one task."""
    group = ["spec", "n_tokens"]
    per = pieces.groupBy(*group, "pid").agg(F.count("*").alias("here"))
    before = F.sum("here").over(Window.partitionBy(*group).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    base = per.select(*group, "pid", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy(*group, "pid").orderBy("key", "piece_no")) - 1
    return pieces.withColumn("within", within).join(base, [*group, "pid"]).withColumn("rank", F.col("base") + F.col("within")).drop("base", "within", "pid")


def pack(df: DataFrame, key: str, text: str, specs: list[Spec], vocabulary: str = DEFAULT_VOCABULARY, step_windows: int = STEP_WINDOWS) -> DataFrame:
    """(spec_name, key, piece_no, token_start, n_tokens, tier, container_id, slot, token_offset, step_group): every text's place for every spec."""
    for s in specs:
        if s.capacity < 1 or s.separator < 0:
            raise ValueError(f"bad spec: {s}")
    sizes = stage(token_counts(df, key, text, vocabulary).withColumn("pid", F.spark_partition_id()), label="token-sizes")
    places = F.array(*[F.struct(F.lit(i).alias("spec"), F.lit(s.capacity).cast("bigint").alias("capacity")) for i, s in enumerate(specs)])
    rows = sizes.select("*", F.inline(places))
    n = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.col("capacity"))).cast("bigint")
    pieces = rows.select("key", "pid", "spec", F.col("n_tokens").alias("whole"), "capacity", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("piece_no"))
    start = F.col("piece_no") * F.col("capacity")
    pieces = pieces.select("key", "pid", "spec", "piece_no", start.alias("token_start"), F.least("capacity", F.col("whole") - start).alias("n_tokens"))
    counts = pieces.where("n_tokens > 0").groupBy("spec", "n_tokens").agg(F.count("*").alias("n")).collect()  # at most the sum of the capacities
    plans = [plan({r.n_tokens: r.n for r in counts if r.spec == i}, s) for i, s in enumerate(specs)]

    # one line of positions: specs, lengths within a spec, ranks within a length
    flat = sorted((i, r.length, r.rank, r) for i, p in enumerate(plans) for r in p.runs)
    width = max((s.capacity for s in specs), default=0) + 1
    start_of = np.zeros(len(specs) * width, np.int64)
    starts, at = np.zeros(len(flat), np.int64), 0
    for j, (i, length, rank, run) in enumerate(flat):
        if rank == 0:
            start_of[i * width + length] = at
        starts[j] = at
        at += run.count
    container, copies, slot, offset = (np.array([getattr(x[3], name) for x in flat], np.int64) for name in ("container", "copies", "slot", "offset"))
    separators = np.array([s.separator for s in specs], np.int64)
    groups = np.array([max(1, -(-p.containers // step_windows)) for p in plans], np.int64)
    names = [s.name for s in specs]
    bounds = [np.array(tiers(s.capacity)[::-1], np.int64) for s in specs]
    kind = df.schema[key].dataType.simpleString()
    columns = ["spec_name", "key", "piece_no", "token_start", "n_tokens", "tier", "container_id", "slot", "token_offset", "step_group"]

    def place(batches):
        for b in batches:
            spec, length, rank = (b.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("spec", "n_tokens", "rank"))
            empty = length == 0
            pos = start_of[spec * width + length] + rank
            j = np.clip(np.searchsorted(starts, pos, "right") - 1, 0, None)
            if len(starts):
                inside = pos - starts[j]
                box, nth = container[j] + inside // copies[j], inside % copies[j]
                where, begin = slot[j] + nth, offset[j] + nth * (length + separators[spec])
            else:
                box = where = begin = np.zeros(len(spec), np.int64)
            turn, seat = box // groups[spec], box % groups[spec]
            step = np.where(turn % 2 == 0, seat, groups[spec] - 1 - seat)
            tier = np.zeros(len(spec), np.int64)
            for i, upper in enumerate(bounds):
                own = spec == i
                tier[own] = upper[np.searchsorted(upper, length[own])]
            placed = [pa.array(x, pa.int64(), mask=empty) for x in (box, where, begin, step)]
            yield pa.record_batch(
                [pa.array([names[i] for i in spec], pa.string()), b.column("key"), b.column("piece_no"), b.column("token_start"), b.column("n_tokens"), pa.array(tier, pa.int64(), mask=empty), *placed],
                columns,
            )

    whole = "bigint"
    out = f"spec_name string, key {kind}, piece_no bigint, token_start bigint, n_tokens bigint, " + ", ".join(f"{c} {whole}" for c in columns[5:])
    if not specs:
        return pieces.sparkSession.createDataFrame([], out)
    return _ranked(pieces).select("spec", "key", "piece_no", "token_start", "n_tokens", "rank").mapInArrow(place, out)


def fill_report(packed: DataFrame, specs: list[Spec]) -> DataFrame:
    """(spec_name, containers, tokens, room, used): how full the containers are, separators counted as used."""
    cap = reduce(lambda a, s: a.when(F.col("spec_name") == s.name, s.capacity), specs[1:], F.when(F.col("spec_name") == specs[0].name, specs[0].capacity))
    boxes = packed.where("container_id is not null").groupBy("spec_name", "container_id").agg(F.max(F.col("token_offset") + F.col("n_tokens")).alias("end"), F.sum("n_tokens").alias("tokens"))
    return boxes.groupBy("spec_name").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.sum(cap).alias("room"), (F.sum("end") / F.sum(cap)).alias("used"))
