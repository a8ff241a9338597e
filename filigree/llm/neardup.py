"""Near-duplicate texts by a self-join of binary tries.

1. Every text becomes the set of its word shingles. Texts with equal sets form
   one class, so copies, however many, are one entry from here on.
2. A set is signed by 128 min-hashes. Two bits of each make a sketch: sketches
   of sets of similarity J differ in (1 - J) / 2 of their bits. The classes are
   the leaves of a forest of 36 binary tries. A leaf's path in a trie is a hash
   of three min-hashes, in which no bit may differ, and below it the sketch, for
   which there is a Hamming budget.
3. Every trie is joined with itself. What lies below one upper path, in which
   no bit may differ, is a task for one worker. From there node pairs are
   walked together, adding up the bits in which they differ, and a pair of
   nodes is dropped with all that lies below as soon as the sum exceeds the
   budget for their depth. Two nodes of one leaf each are compared over the
   rest of their path at once. All subtries of a partition are walked side by
   side, level by level, in arrays.
4. What is left is compared exactly on the shingle sets.

An upper path with more than ``BUCKET`` leaves is spread over several tasks:
its classes are salted into blocks, and each pair of blocks is one trie join,
so no task holds an unbounded subtrie and no pair is lost.

Of pairs of similarity 0.6 the upper paths of the 36 tries miss one in 6,400, of
0.7 one in 4,000,000; the budgets (four standard deviations) miss one in 20,000.

Defined results: null texts and texts under ``min_words`` take no part;
repeated keys are joined to each other's partners but never paired with
themselves; columns of other names are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches, stage

#: Min-hashes, two bits of each for a sketch; the first ``TRIES`` times ``UPPER`` also make the upper paths.
HASHES, TRIES, UPPER = 128, 36, 3
BITS = 2 * HASHES
BUCKET = 20_000
#: Rows that a worker joins together, when no upper path has as many.
ROWS_AT_ONCE = 200_000
CHUNK_BYTES = 1 << 20
PAIR_BLOCK = 2_000

_TAG = re.compile(r"<[^>]*>")
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(0, n - 1), base, np.uint64)))) if n else np.ones(0, np.uint64)


class Shingler:
    """Hashes of the word shingles of many texts, in arrays."""

    def __init__(self, width: int) -> None:
        self.width = width
        self._up = self._down = np.ones(0, np.uint64)

    def __call__(self, texts: list[str]) -> list[tuple[int, np.ndarray]]:
        """(number of words, shingle hashes in order) of each text."""
        raw = [(_TAG.sub("", t) if "<" in t else t).lower().encode("utf-8", "surrogatepass") for t in texts]
        out: list[tuple[int, np.ndarray]] = []
        at = 0
        while at < len(raw):
            end, size = at, 0
            while end < len(raw) and (end == at or size + len(raw[end]) < CHUNK_BYTES):
                size += len(raw[end]) + 1
                end += 1
            out += self._chunk(raw[at:end])
            at = end
        return out

    def _chunk(self, raw: list[bytes]) -> list[tuple[int, np.ndarray]]:
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        n = len(data)
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, n), _powers(_INVERSE, n)
        inside = _WORD[data]
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        a, z = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * self._up[:n])))
        word = _mixed((sums[z] - sums[a]) * self._down[a])
        starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
        first = np.searchsorted(a, starts)
        key = np.zeros(max(0, len(word) - self.width + 1), np.uint64)
        for k in range(self.width):
            key = _mixed(key * np.uint64(3) + word[k : k + len(key)])
        return [(int(w - v), key[v : max(v, w - self.width + 1)]) for v, w in zip(first[:-1], first[1:])]


def sign(hashes: np.ndarray) -> np.ndarray:
    """The min-hashes of a set; long sets are taken in slices."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = (hashes[at : at + 4096, None] ^ _SHIFTS) * _FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    return _mixed(least)


def sketch(minima: np.ndarray) -> bytes:
    """One bit of every min-hash, then another of each."""
    return np.packbits(np.concatenate((minima & np.uint64(1), (minima >> np.uint64(1)) & np.uint64(1))).astype(np.uint8)).tobytes()


def upper_paths(minima: np.ndarray, salt: int) -> np.ndarray:
    """The upper path of a set in each trie."""
    key = np.full(TRIES, salt & ((1 << 64) - 1), np.uint64) + np.arange(TRIES, dtype=np.uint64)
    for k in range(UPPER):
        key = _mixed(key * np.uint64(3) + minima[k * TRIES : (k + 1) * TRIES])
    return key.view(np.int64)


def budgets(threshold: float, deviations: float = 4.0) -> np.ndarray:
    """Bits in which the sketches of sets at the threshold may differ, down to each depth."""
    apart = 1 - threshold
    depth = np.arange(BITS + 1)
    twice = np.maximum(depth - HASHES, 0)
    # a bit differs for half of the min-hashes that do; two bits of one hash differ or agree together
    one, two = apart / 2 * (1 - apart / 2), apart / 2 + apart * (1 - apart)
    variance = (depth - 2 * twice) * one + twice * two
    return np.minimum(depth, np.ceil(depth * apart / 2 + deviations * np.sqrt(variance))).astype(np.int64)


@dataclass
class Walk:
    """What a join of tries did: node pairs visited, node pairs dropped before the end of their paths, pairs of leaves met, leaf pairs left."""

    visited: int = 0
    dropped: int = 0
    compared: int = 0
    left: int = 0


def _ranges(a0, a1, b0, b1, same):
    """All index pairs of pairs of ranges, of a range with itself each pair once."""
    na, nb = a1 - a0, b1 - b0
    n = na * nb
    which = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = a0[which] + k // nb[which], b0[which] + k % nb[which]
    keep = ~same[which] | (i < j)
    return i[keep], j[keep]


def trie_join(starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_ends: np.ndarray, sketches: np.ndarray, most: np.ndarray, wide: int = 1 << 20, walk: Walk | None = None):
    """Index pairs whose sketches differ in no more than ``most`` bits, of the given pairs of ranges.

    ``most`` holds the budget down to each depth. ``sketches`` (n x words, high
    first) ascend within each range. Yields arrays (i, j); a range paired with
    itself gives each pair once.
    """
    bits = sketches.shape[1] * 64
    walk = walk or Walk()
    stack = [(0, (starts, ends, others, other_ends, np.zeros(len(starts), np.int64)))]
    while stack:
        depth, (a0, a1, b0, b1, err) = stack.pop()
        if len(a0) > wide:
            half = len(a0) // 2
            stack += [(depth, tuple(x[half:] for x in (a0, a1, b0, b1, err))), (depth, tuple(x[:half] for x in (a0, a1, b0, b1, err)))]
            continue
        walk.visited += len(a0)
        # two leaves: the rest of their path at once
        ready = ((a1 - a0 == 1) & (b1 - b0 == 1)) | (depth == bits)
        if ready.any():
            at = np.flatnonzero(ready)
            sizes = np.cumsum((a1[at] - a0[at]) * (b1[at] - b0[at]))
            for part in np.split(at, np.searchsorted(sizes, np.arange(wide, sizes[-1], wide))):
                if len(part):
                    i, j = _ranges(a0[part], a1[part], b0[part], b1[part], a0[part] == b0[part])
                    walk.compared += len(i)
                    differ = np.zeros(len(i), np.int64)
                    for k in range(bits // 64):
                        differ += np.bitwise_count(sketches[i, k] ^ sketches[j, k])
                        keep = differ <= most[64 * (k + 1)]
                        walk.dropped += 0 if k + 1 == bits // 64 else int(len(keep) - keep.sum())
                        i, j, differ = i[keep], j[keep], differ[keep]
                    walk.left += len(i)
                    yield i, j
            a0, a1, b0, b1, err = (x[~ready] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        # where each node's ones begin: its leaves ascend, so those with a zero at this depth come first
        word, mask = sketches[:, depth // 64], np.uint64(1) << np.uint64(63 - depth % 64)
        am, bm = _first_one(word, mask, a0, a1), _first_one(word, mask, b0, b1)
        crossed = a0 != b0
        nodes = [(a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1), tuple(x[crossed] for x in (am, a1, b0, bm, err + 1))]
        nodes = [np.concatenate(x) for x in zip(*nodes)]
        there = (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & ((nodes[0] != nodes[2]) | (nodes[1] - nodes[0] > 1))
        alive = there & (nodes[4] <= most[depth + 1])
        walk.dropped += int(there.sum() - alive.sum())
        stack.append((depth + 1, tuple(x[alive] for x in nodes)))


def _first_one(word: np.ndarray, mask: np.uint64, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first leaf of each range with a one in the bit, by halving."""
    low, high = start.copy(), end.copy()
    open_ = np.arange(len(low))
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        one = (word[mid] & mask) != 0
        high[open_[one]] = mid[one]
        low[open_[~one]] = mid[~one] + 1
        open_ = open_[low[open_] < high[open_]]
    return low


def _sets(width: int, min_words: int, kind: pa.DataType):
    def work(batches):
        shingler = Shingler(width)
        for b in batches:
            keep = [i for i, t in enumerate(b.column("text").to_pylist()) if t is not None]
            got = shingler(b.column("text").take(pa.array(keep, pa.int64())).to_pylist())
            groups = b.column("within").to_pylist()
            at, sets, cls, marks, keys = [], [], [], [], []
            for i, (n, hashes) in zip(keep, got):
                if n < min_words or not len(hashes):
                    continue
                salt = xxhash.xxh3_64_intdigest(str(groups[i]))
                whole = np.unique(hashes)
                minima = sign(whole)
                at.append(i)
                sets.append(np.unique((whole >> np.uint64(32)).astype(np.uint32)).view(np.int32))
                cls.append(xxhash.xxh3_64_intdigest(whole.tobytes(), seed=salt) - (1 << 63))
                marks.append(sketch(minima))
                keys.append(upper_paths(minima, salt))
            flat = lambda parts, t: pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), pa.array(np.concatenate(parts) if parts else np.zeros(0, t)))
            yield pa.record_batch(
                [b.column("id").take(pa.array(at, pa.int64())), pa.array(cls, pa.int64()), pa.array(marks, pa.binary()), flat(keys, np.int64), flat(sets, np.int32)],
                ["id", "class", "sketch", "paths", "shingles"],
            )

    return work


def _join(most: np.ndarray):
    """Trie joins of rows (path, x, y, own, class, sketch), sorted so far: blocks x and y below an upper path, ``own`` the row's block. Whole subtries are joined, many at once."""

    def joined(t: pa.Table):
        path, x, y, own, cls = (t.column(c).to_numpy() for c in ("path", "x", "y", "own", "class"))
        marks = np.frombuffer(b"".join(v for chunk in t.column("sketch").chunks for v in chunk.to_pylist()), ">u8").astype(np.uint64).reshape(-1, BITS // 64)
        order = np.lexsort((*marks.T[::-1], own, y, x, path))
        path, x, y, own, cls, marks = path[order], x[order], y[order], own[order], cls[order], marks[order]
        task = np.flatnonzero(np.concatenate(([True], (np.diff(path) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0), [True])))
        a, z = task[:-1], task[1:]
        # rows of block x come before those of block y
        late = np.concatenate(([0], np.cumsum(own != x)))
        mid = z - (late[z] - late[a])
        alone = x[a] == y[a]
        b0, b1, a1 = np.where(alone, a, mid), z, np.where(alone, z, mid)
        live = np.where(alone, z - a > 1, (mid > a) & (z > mid))
        found = [(cls[i], cls[j]) for i, j in trie_join(a[live], a1[live], b0[live], b1[live], marks, most)]
        if found:
            i, j = (np.concatenate(v) for v in zip(*found))
            pairs = np.unique(np.stack((np.minimum(i, j), np.maximum(i, j)), axis=1), axis=0)
            for at in range(0, len(pairs), 50_000):
                yield pa.record_batch([pa.array(pairs[at : at + 50_000, 0]), pa.array(pairs[at : at + 50_000, 1])], ["a", "b"])

    def work(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < ROWS_AT_ONCE:
                continue
            t = pa.Table.from_batches(held)
            # the last subtrie may go on in the next batch
            names = [t.column(c).to_numpy() for c in ("path", "x", "y")]
            cut = int(np.flatnonzero(np.concatenate(([True], np.any([np.diff(v) != 0 for v in names], axis=0))))[-1])
            if cut:
                yield from joined(t.slice(0, cut))
                t = t.slice(cut)
            held, rows = t.combine_chunks().to_batches(), t.num_rows
        if held:
            yield from joined(pa.Table.from_batches(held))

    return work


@dataclass(frozen=True)
class NearDuplicates:
    """``members``: (keys..., class); ``links``: (a, b, similarity), a < b, of different classes at or above the threshold."""

    keys: list[str]
    members: DataFrame
    links: DataFrame

    def classes(self) -> DataFrame:
        """(keys..., class, copies, links): one row for each text, with the copies in its class and the classes linked to it."""
        ends = self.links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
        copies = self.members.groupBy("class").agg(F.count("*").alias("copies"))
        return self.members.join(copies, "class").join(ends, "class", "left").select(*self.keys, "class", "copies", F.coalesce("links", F.lit(0)).alias("links"))

    def pairs(self) -> DataFrame:
        """(id_a, id_b): structs of the keys of every two similar texts, copies written out, id_a < id_b."""
        rows = self.members.select(F.struct(*self.keys).alias("id"), "class").distinct()
        a, b = rows.select(F.col("id").alias("p"), F.col("class").alias("a")), rows.select(F.col("id").alias("q"), F.col("class").alias("b"))
        across = self.links.select("a", "b").join(a, "a").join(b, "b").select("p", "q")
        # copies meet in blocks
        sizes = rows.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class", F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("blocks"))
        several = rows.join(sizes, "class")
        left = several.select("class", F.col("id").alias("p"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
        right = several.select("class", F.col("id").alias("q"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        same = left.join(right, ["class", "block"]).where("p < q").select("p", "q")
        return across.unionByName(same).where("p <> q").select(F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b")).distinct()


def near_duplicates(df: DataFrame, keys: list[str], text: str, within: list[str] | None = None, threshold: float = 0.8, width: int = 5, min_words: int = 30, bucket_rows: int = BUCKET) -> NearDuplicates:
    """Texts whose shingle sets have a Jaccard similarity of ``threshold`` or more; only texts with equal ``within`` columns pair."""
    bound_batches(df.sparkSession)
    rows = df.select(F.struct(*keys).alias("id"), F.to_json(F.struct(*within)).alias("within") if within else F.lit("").alias("within"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sets = stage(rows.mapInArrow(_sets(width, min_words, None), f"id {kind}, class bigint, sketch binary, paths array<bigint>, shingles array<int>"), label="shingle-sets")
    classes = sets.groupBy("class").agg(F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))
    entries = classes.select("class", "sketch", F.explode("paths").alias("path"))
    hot = stage(entries.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows), label="hot-paths")
    one = F.lit(0).cast("int")
    plain = entries.select("path", one.alias("x"), one.alias("y"), one.alias("own"), "class", "sketch")
    if hot.limit(1).count():
        plain = plain.join(hot.select("path"), "path", "left_anti")
        blocks = F.ceil(F.col("n") / bucket_rows).cast("int")
        salted = entries.join(hot, "path").select("path", "class", "sketch", blocks.alias("blocks"), F.pmod(F.xxhash64("class", F.lit(1)), blocks).cast("int").alias("own"))
        salted = salted.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        plain = plain.unionByName(salted.select("path", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "class", "sketch"))
    tries = plain.repartition("path", "x", "y").sortWithinPartitions("path", "x", "y")
    candidates = stage(tries.mapInArrow(_join(budgets(threshold)), "a bigint, b bigint").distinct(), label="candidates")
    needed = candidates.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    held = sets.select("class", "shingles").join(needed, "class", "left_semi").groupBy("class").agg(F.first("shingles").alias("shingles"))
    held = stage(held, label="sets-to-compare")
    a, b = held.withColumnsRenamed({"class": "a", "shingles": "sa"}), held.withColumnsRenamed({"class": "b", "shingles": "sb"})
    both = F.size(F.array_intersect("sa", "sb")).cast("double")
    compared = candidates.join(a, "a").join(b, "b").select("a", "b", (both / (F.size("sa") + F.size("sb") - both)).alias("similarity"))
    links = stage(compared.where(F.col("similarity") >= threshold), label="links")
    members = sets.select("id.*", "class").distinct()
    return NearDuplicates(keys, members, links)
