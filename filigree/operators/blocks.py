"""Sections into chunks of whole paragraphs and tables, greedily up to a size, with trailing paragraphs repeated."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches

_TABLE = re.compile(r"<table\b[^>]*>.*?</table>", re.DOTALL | re.IGNORECASE)


@dataclass(frozen=True)
class Limits:
    most: int = 512
    overlap: int = 50
    least: int = 100
    per_word: float = 1.33

    def size(self, text: str) -> int:
        return floor(len(text.split()) * self.per_word)


def blocks(markdown: str) -> Iterator[tuple[str, bool]]:
    """(text, is table): tables whole, other text by blank lines, without empty ones."""
    at = 0
    for m in [*_TABLE.finditer(markdown), None]:
        for paragraph in markdown[at : m.start() if m else len(markdown)].strip().split("\n\n"):
            if paragraph.strip():
                yield paragraph.strip(), False
        if m:
            yield m.group(), True
            at = m.end()


def fold(markdown: str, limits: Limits) -> list[tuple[str, int, bool]]:
    """(text, tokens, has a table) of the chunks.

    A table over the limit stands alone and ends what came before, without
    repeating any of it; a paragraph over the limit stays whole; a rest under
    the least size without a table is left out.
    """
    out: list[list[tuple[str, int, bool]]] = []
    held: list[tuple[str, int, bool]] = []
    for text, table in blocks(markdown):
        block = (text, limits.size(text), table)
        if table and block[1] > limits.most:
            out += [held] * bool(held) + [[block]]
            held = []
            continue
        if held and sum(b[1] for b in held) + block[1] > limits.most:
            out.append(held)
            room, again = limits.overlap, []
            for b in reversed(held):
                if b[2] or b[1] > room:
                    break
                room -= b[1]
                again.insert(0, b)
            held = again
        held = [*held, block]
    if held and (sum(b[1] for b in held) >= limits.least or any(b[2] for b in held)):
        out.append(held)
    texts = [("\n\n".join(b[0] for b in part), any(b[2] for b in part)) for part in out]
    return [(text, limits.size(text), table) for text, table in texts]


def chunk(sections: DataFrame, key: str, text: str, limits: Limits = Limits(), least_words: int = 10) -> DataFrame:
    """(key, chunk_index, text, token_count, contains_table) of sections with at least ``least_words`` words."""
    bound_batches(sections.sparkSession)

    def work(batches):
        for b in batches:
            at, rows = [], []
            for i, markdown in enumerate(b.column(1).to_pylist()):
                if markdown and len(markdown.split()) >= least_words:
                    for n, part in enumerate(fold(markdown, limits)):
                        at.append(i)
                        rows.append((n, *part))
            cols = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.bool_()]
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["key", "chunk_index", "text", "token_count", "contains_table"])

    rows = sections.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"key {sections.schema[key].dataType.simpleString()}, chunk_index int, text string, token_count int, contains_table boolean")
