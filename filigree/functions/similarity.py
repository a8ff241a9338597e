"""Similarity of short strings and vectors made without a model."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches

#: Names in a block; each pair of blocks is a row of work.
BLOCK = 2048


def ratio(a: Column, b: Column) -> Column:
    """Share of characters that need no edit, in percent, rounded: 100 for equal strings, by Levenshtein distance."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100).otherwise(F.round((1 - F.levenshtein(a, b) / longest) * 100).cast("int"))


def hashed_embedding(words: Column, dim: int = 64) -> Column:
    """A unit vector of an array of words: each word adds or takes one at a place given by its hash; null for no words. Equal texts have equal vectors."""

    @F.pandas_udf("array<float>")
    def embed(batch: pd.Series) -> pd.Series:
        spots: dict[str, int] = {}

        def one(row):
            if row is None or not len(row):
                return None
            at = np.array([spots.get(w) or spots.setdefault(w, xxhash.xxh3_64_intdigest(w) >> 1) for w in row if w is not None], np.int64)
            raw = np.bincount(at % dim, np.where(at >> 40 & 1, 1.0, -1.0), dim)
            norm = np.linalg.norm(raw)
            return (raw / norm).astype(np.float32) if norm else None

        return batch.map(one)

    return embed(words)


def _marks(chars: np.ndarray) -> np.ndarray:
    """128 bits a row, of which one inserted or deleted character turns exactly one: the n-th occurrence of a character turns the bit given by both."""
    s = np.sort(chars, axis=1)
    place = np.arange(s.shape[1])
    first = np.maximum.accumulate(np.where(np.append(np.ones((len(s), 1), bool), s[:, 1:] != s[:, :-1], axis=1), place, 0), axis=1)
    h = (s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ ((place - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    spot = (h * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(57)
    bit = np.uint64(1) << (spot & np.uint64(63))
    return np.stack([np.bitwise_xor.reduce(np.where(spot >> np.uint64(6) == w, bit, np.uint64(0)), axis=1) for w in (0, 1)])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of ``a`` with the same row of ``b``."""
    best = np.zeros((len(a), b.shape[1] + 1), np.int32)
    for i in range(a.shape[1]):
        best[:, 1:] = np.maximum(best[:, 1:], best[:, :-1] + (b == a[:, i : i + 1]))
        np.maximum.accumulate(best, axis=1, out=best)
    return best[:, -1]


def close_names(names: DataFrame, least: int = 90) -> DataFrame:
    """(type, a, b, ratio) of all names (type, name) of a type with a < b: twice the longest common subsequence over both lengths, in percent, rounded, is at least ``least``.

    Names are compared in blocks of one length, with those blocks whose length
    allows the ratio; marks that no pair above it can miss go first, then the
    subsequence itself is measured.
    """
    bound_batches(names.sparkSession)
    size = F.length("name")
    rows = names.where("type is not null and name <> ''").select("type", "name").distinct().withColumn("size", size)
    counts = rows.groupBy("type", "size").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = rows.join(counts, ["type", "size"]).withColumn("block", F.expr("pmod(xxhash64(name), blocks)"))
    blocks = rows.groupBy("type", "size", "block").agg(F.collect_list("name").alias("names"))
    other = blocks.select("type", *[F.col(c).alias(f"{c}_b") for c in ("size", "block", "names")])
    # edits allowed, in thousandths of both lengths; a half is rounded up
    slack = 1000 - (10 * least - 5)
    pairs = blocks.join(other, "type").where(f"(size < size_b or size = size_b and block <= block_b) and 1000 * (size_b - size) <= {slack} * (size + size_b)")
    pairs = pairs.repartition(F.col("size"), F.col("block"), F.col("size_b"), F.col("block_b"))

    def compare(batches):
        view = lambda x, n: np.array(x, f"<U{n}").view(np.uint32).reshape(len(x), n)
        for batch in batches:
            for r in range(batch.num_rows):
                kind, m, n, left, right, same = (batch.column(c)[r].as_py() for c in ("type", "size", "size_b", "names", "names_b", "same"))
                a, b = view(left, m), view(right, n)
                x, y = _marks(a), _marks(b)
                out = []
                for at in range(0, len(a), 256):
                    apart = sum(np.bitwise_count(x[w, at : at + 256, None] ^ y[w][None]) for w in (0, 1))
                    i, j = np.nonzero(apart <= slack * (m + n) // 1000)
                    i += at
                    for cut in range(0, len(i), 1 << 14):
                        p, q = i[cut : cut + (1 << 14)], j[cut : cut + (1 << 14)]
                        common = _common(a[p], b[q])
                        ok = 1000 * (m + n - 2 * common) <= slack * (m + n)
                        out += [(*sorted((left[u], right[v])), (400 * int(c) + m + n) // (2 * (m + n))) for u, v, c in zip(p[ok], q[ok], common[ok]) if (left[u] < right[v] if same else left[u] != right[v])]
                cols = list(zip(*out)) if out else [()] * 3
                yield pa.record_batch([pa.array([kind] * len(out), pa.string()), *[pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32()))]], ["type", "a", "b", "ratio"])

    pairs = pairs.withColumn("same", F.expr("size = size_b and block = block_b"))
    return pairs.mapInArrow(compare, "type string, a string, b string, ratio int")
