"""Splitting oversized texts into overlapping pieces at natural boundaries.

A text is worked on in byte ranges, as many as it is long, in four steps.

1. The worker of a range sees its bytes and a halo on either side. It finds the
   words that begin and end among its own bytes and grades the gaps before
   them (heading, paragraph, line, sentence, word): its part of the boundary
   table, which also says what a gap that reaches over its edges holds so far.
2. The parts are stitched in order: gaps at the seams get their grades, and
   prefix sums of words and characters place every part in the whole text.
3. Pieces are cut along the stitched table, read as a stream. No piece depends
   on where the ranges lie.
4. The ranges that hold the ends of pieces turn word numbers into offsets, and
   the pieces are emitted by offset.

A text of one range is stitched, cut and emitted where it was scanned, by the
same functions. Giant files are read range by range and piece by piece, and no
worker holds one whole.

Size is the number of words (runs of characters other than space, tab, CR and
LF) times ``tokens_per_word``, rounded down. A piece has at most as many words
as fit ``max_tokens``, counting the overlap: the words before the cut that fit
``overlap_tokens`` are repeated at the start of the next piece.

Defined results: null, empty and blank texts and texts within the limit give
no piece; a limit that fits no word beside the overlap is refused; a single
word is never cut; repeated rows are split row by row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.runtime import bound_batches, stage

#: Bytes of a range of a file, and of a text in a row of a table.
FILE_RANGE = 4 << 20
RANGE = 8 << 10
#: Bytes seen beyond a range: the two before it end its last word or not, and the one after it says whether a word goes on.
HALO = 4
GRADES = ("word", "sentence", "line", "paragraph", "heading", "end")
END = 5

_WS = np.zeros(256, bool)
_WS[[9, 10, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSE = np.zeros(256, bool)
_CLOSE[list(b"\"')]*_")] = True


@dataclass(frozen=True)
class Config:
    name: str
    max_tokens: int
    overlap_tokens: int = 0
    min_tokens: int = 0
    tokens_per_word: float = 1.0

    def words(self, tokens: int) -> int:
        """The most words whose size is within ``tokens``."""
        n = max(0, int(tokens / self.tokens_per_word) - 1)
        while floor((n + 1) * self.tokens_per_word) <= tokens:
            n += 1
        return n

    def size(self, words: int) -> int:
        return floor(words * self.tokens_per_word)

    def checked(self) -> Config:
        if self.tokens_per_word <= 0 or self.words(self.max_tokens) <= self.words(self.overlap_tokens):
            raise ValueError(f"no word fits beside the overlap: {self}")
        return self

    def limits(self) -> tuple[int, int, int]:
        """Words of a piece, of its overlap and the least before a cut."""
        return self.words(self.max_tokens), self.words(self.overlap_tokens), self.words(self.min_tokens)


def grade_of(stop, breaks, heading):
    """Grade of a gap: whether a sentence ends before it, its line ends, and whether a heading follows."""
    g = np.where(stop, 1, 0)
    g = np.where(breaks == 1, 2, g)
    g = np.where(breaks > 1, 3, g)
    return np.where((breaks > 0) & heading, 4, g)


class Scan:
    """Words of slices of UTF-8 that lie one after another in a buffer; of each slice only the bytes from ``own`` to ``stop`` are its own."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, own: np.ndarray, stop: np.ndarray) -> None:
        n = len(data)
        self.data, self.own, self.stop = data, own, stop
        space = _WS[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        begins, ends = ~space, ~space
        begins[1:] &= space[:-1] | first[1:-1]
        ends[:-1] &= space[1:] | first[1:-1]
        mine = np.zeros(n + 1, np.int8)
        np.add.at(mine, own, 1)
        np.add.at(mine, stop, -1)
        mine = np.cumsum(mine[:n]).astype(bool)
        self.starts = np.flatnonzero(begins & mine)
        self.ends = np.flatnonzero(ends & mine) + 1
        newline = data == 10
        newline |= (data == 13) & np.append(data[1:] != 10, True)
        self.lines = np.concatenate(([0], np.cumsum(newline & mine, dtype=np.int64)))
        self.of_start = np.searchsorted(self.starts, np.append(own, n))  # starts of slice i: of_start[i] to of_start[i + 1]
        self.of_end = np.searchsorted(self.ends, np.append(own + 1, n + 1))
        self.heads = data[self.starts] == 35
        tail = data[self.ends - 1]
        before = np.where(self.ends - 2 >= offsets[np.searchsorted(offsets, self.ends - 1, "right") - 1], data[np.maximum(self.ends - 2, 0)], 32)
        self.stops = _STOP[tail] | (_CLOSE[tail] & _STOP[before]) | ((tail == 0x82) & (before == 0x80))
        # grades of the gaps before all words whose gap begins in the same slice
        last = np.searchsorted(self.ends, self.starts, "right") - 1
        at = np.searchsorted(own, self.starts, "right") - 1
        inside = (last >= 0) & (last >= self.of_end[at])
        k = np.maximum(last, 0)
        self.inside = inside
        breaks = self.lines[self.starts] - self.lines[self.ends[k]] if len(self.ends) else np.zeros(len(self.starts), np.int64)
        self.grade = np.where(inside, grade_of(self.stops[k], breaks, self.heads), 0).astype(np.uint8) if len(self.ends) else np.zeros(len(self.starts), np.uint8)
        self._chars: np.ndarray | None = None

    @property
    def chars(self) -> np.ndarray:
        """Characters that begin before each byte."""
        if self._chars is None:
            self._chars = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80, dtype=np.int64)))
        return self._chars

    def part(self, i: int) -> Part:
        a, z = int(self.of_start[i]), int(self.of_start[i + 1])
        b, y = int(self.of_end[i]), int(self.of_end[i + 1])
        o, s = int(self.own[i]), int(self.stop[i])
        graded = np.flatnonzero(self.grade[a:z])
        open_ = z > a and not self.inside[a]
        return Part(
            z - a, y - b, open_, int(self.lines[self.starts[a]] - self.lines[o]) if open_ else 0, bool(open_ and self.heads[a]), bool(y > b and self.stops[y - 1]),
            int(self.lines[s] - (self.lines[self.ends[y - 1]] if y > b else self.lines[o])), graded, self.grade[a:z][graded],
        )


@dataclass(frozen=True)
class Part:
    """A range's part of the boundary table: words that begin and end in it, what is open at its edges, and the graded gaps by number of the word after them."""

    starts: int
    ends: int
    open: bool  # the gap before the first word began in an earlier range
    lead: int  # line ends of that gap here
    heading: bool
    stop: bool  # the last word that ends here ends a sentence
    trail: int  # line ends after it
    places: np.ndarray
    grades: np.ndarray


class Cutter:
    """Stitches the parts of one text, in order, and cuts it for every configuration as far as its words are known."""

    def __init__(self, limits: list[tuple[int, int, int]]) -> None:
        self.limits = limits
        self.words = self.ended = 0
        self._stop, self._breaks = False, 0
        self._marks: dict[int, list[int]] = {g: [] for g in (4, 3, 2, 1)}
        self._at = [0] * len(limits)
        self._n = [0] * len(limits)

    def add(self, p: Part) -> None:
        places, grades = p.places + self.words, p.grades
        if p.open and self.words:
            g = int(grade_of(self._stop, self._breaks + p.lead, p.heading))
            if g:
                places, grades = np.append(self.words, places), np.append(g, grades)
        for g, marks in self._marks.items():
            marks += places[grades >= g].tolist()
        if p.ends:
            self._stop, self._breaks = p.stop, p.trail
        else:
            self._breaks += p.trail
        self.words += p.starts
        self.ended += p.ends

    def _end(self, at: int, limit: int, least: int) -> tuple[int, int]:
        for low in (max(least, limit // 2, 1), max(min(least, limit), 1)):
            for g, marks in self._marks.items():
                j = bisect_right(marks, at + limit) - 1
                if j >= 0 and marks[j] >= at + low:
                    return marks[j], g
        return at + limit, 0

    def cuts(self, whole: bool) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(configuration, piece, first word, first new word, end word, grade of the end) of the pieces that are certain by now, all if the text is whole."""
        for c, (room, overlap, least) in enumerate(self.limits):
            if whole and not self._n[c] and self.words <= room:
                continue
            while True:
                at = self._at[c]
                repeat = min(overlap, at)
                limit = room - repeat
                if self.words - at > limit:
                    end, kind = self._end(at, limit, least)
                elif whole and self.words > at:
                    end, kind = self.words, END
                else:
                    break
                yield c, self._n[c], at - repeat, at, end, kind
                self._at[c], self._n[c] = end, self._n[c] + 1
        if not whole:
            done = min(self._at, default=0)
            for marks in self._marks.values():
                del marks[: bisect_left(marks, done)]


PIECE = "config_name string, piece bigint, start_char bigint, end_char bigint, start_word bigint, end_word bigint, overlap_words bigint, boundary string"
_PIECE = ["config_name", "piece", "start_char", "end_char", "start_word", "end_word", "overlap_words", "boundary"]
_PIECE_KINDS = [pa.string(), *[pa.int64()] * 6, pa.string()]


def _buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts or binaries, nulls empty, and where each begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _whole(configs: list[Config], with_text: bool):
    """Rows (id, text) to pieces, of texts of one range."""
    limits = [c.limits() for c in configs]
    smallest = min((x[0] for x in limits), default=1 << 62)

    def work(batches):
        for b in batches:
            data, offsets = _buffer(b.column("text"))
            s = Scan(data, offsets, offsets[:-1], offsets[1:])
            index: list[int] = []
            rows: list[tuple] = []
            for i in np.flatnonzero(np.diff(s.of_start) > smallest).tolist():
                cutter = Cutter(limits)
                cutter.add(s.part(i))
                a, zero = int(s.of_start[i]), s.chars[offsets[i]]
                for c, piece, start, new, end, kind in cutter.cuts(True):
                    x, y = int(s.starts[a + start]), int(s.ends[a + end - 1])
                    index.append(i)
                    rows.append((configs[c].name, piece, int(s.chars[x] - zero), int(s.chars[y] - zero), start, end, new - start, GRADES[kind], data[x:y].tobytes().decode("utf-8", "replace") if with_text else None))
            cols = list(zip(*rows)) if rows else [()] * 9
            n = 9 if with_text else 8
            yield pa.record_batch([b.column("id").take(pa.array(index, pa.int64())), *[pa.array(c, k) for c, k in zip(cols[:n], [*_PIECE_KINDS, pa.string()])]], ["id", *_PIECE, "piece_text"][: n + 1])

    return work


TABLE = "starts bigint, ends bigint, chars bigint, open boolean, lead bigint, heading boolean, stop boolean, trail bigint, places binary, grades binary"


def _table_rows(s: Scan, n: int) -> list[pa.Array]:
    """The parts of ``n`` slices as columns of ``TABLE``."""
    parts = [s.part(i) for i in range(n)]
    chars = s.chars[s.stop] - s.chars[s.own]
    number = lambda f: pa.array([f(p) for p in parts], pa.int64())
    flag = lambda f: pa.array([f(p) for p in parts], pa.bool_())
    return [
        number(lambda p: p.starts), number(lambda p: p.ends), pa.array(chars[:n], pa.int64()), flag(lambda p: p.open), number(lambda p: p.lead), flag(lambda p: p.heading), flag(lambda p: p.stop), number(lambda p: p.trail),
        pa.array([p.places.astype(np.int32).tobytes() for p in parts], pa.binary()), pa.array([p.grades.tobytes() for p in parts], pa.binary()),
    ]


def _sliced(b: pa.RecordBatch) -> Scan:
    data, offsets = _buffer(b.column("text"))
    own = offsets[:-1] + np.array(b.column("left").to_pylist(), np.int64)
    return Scan(data, offsets, own, own + np.array(b.column("own").to_pylist(), np.int64))


def _scan(batches):
    """Rows (id, part, left, own, text) to the boundary table."""
    names = [x.split()[0] for x in TABLE.split(", ")]
    for b in batches:
        yield pa.record_batch([b.column("id"), b.column("part"), *_table_rows(_sliced(b), b.num_rows)], ["id", "part", *names])


#: One end of a piece: the range and the number there of the word that begins or ends.
ENDS = "part bigint, begins boolean, nth bigint, chars_before bigint, config_name string, piece bigint, start_word bigint, end_word bigint, overlap_words bigint, boundary string"


def _cut(configs: list[Config]):
    """Boundary tables, sorted by id and part, to the ends of pieces."""
    limits = [c.limits() for c in configs]
    names = ["id", *[x.split()[0] for x in ENDS.split(", ")]]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string()]

    def work(batches):
        now, cutter = None, Cutter(limits)
        where: list[tuple[int, int, int, int]] = []  # words begun, words ended and characters before each range, and its number
        kind = None

        def rows(whole):
            for c, piece, start, new, end, grade in cutter.cuts(whole):
                said = (configs[c].name, piece, start, end, new - start, GRADES[grade])
                a, _, chars, part = where[bisect_right(where, start, key=lambda x: x[0]) - 1]
                yield (part, True, start - a, chars, *said)
                _, e, chars, part = where[bisect_right(where, end - 1, key=lambda x: x[1]) - 1]
                yield (part, False, end - 1 - e, chars, *said)

        def batch(ids, out):
            cols = list(zip(*out)) if out else [()] * len(kinds)
            return pa.record_batch([pa.array(ids, kind), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names)

        for b in batches:
            kind = b.column("id").type
            ids: list = []
            out: list[tuple] = []
            cols = [b.column(x).to_pylist() for x in ("id", "part", "starts", "ends", "chars", "open", "lead", "heading", "stop", "trail", "places", "grades")]
            for id_, part, starts, ends, chars, open_, lead, heading, stop, trail, places, grades in zip(*cols):
                if id_ != now:
                    found = list(rows(True)) if where else []
                    ids += [now] * len(found)
                    out += found
                    now, cutter, where, before = id_, Cutter(limits), [], 0
                where.append((cutter.words, cutter.ended, before, part))
                before += chars
                cutter.add(Part(starts, ends, open_, lead, heading, stop, trail, np.frombuffer(places, np.int32).astype(np.int64), np.frombuffer(grades, np.uint8)))
                found = list(rows(False))
                ids += [now] * len(found)
                out += found
            yield batch(ids, out)
        if where:
            found = list(rows(True))
            yield batch([now] * len(found), found)

    return work


def _offsets(batches):
    """Ranges with the ends of pieces in them, ``asked`` (begins, nth) in a list, to (asked, offset in bytes and characters) within the range's own."""
    for b in batches:
        s = _sliced(b)
        index, begins, nth, byte, char = [], [], [], [], []
        for i, asked in enumerate(b.column("asked").to_pylist()):
            a, e, o = int(s.of_start[i]), int(s.of_end[i]), int(s.own[i])
            for x in asked:
                at = int(s.starts[a + x["nth"]]) if x["begins"] else int(s.ends[e + x["nth"]])
                index.append(i)
                begins.append(x["begins"])
                nth.append(x["nth"])
                byte.append(at - o)
                char.append(int(s.chars[at] - s.chars[o]))
        take = pa.array(index, pa.int64())
        yield pa.record_batch(
            [b.column("id").take(take), b.column("part").take(take), pa.array(begins, pa.bool_()), pa.array(nth, pa.int64()), pa.array(byte, pa.int64()), pa.array(char, pa.int64())],
            ["id", "part", "begins", "nth", "byte", "char"],
        )


def _in_ranges(ranges: DataFrame, read, configs: list[Config], range_bytes: int) -> DataFrame:
    """(id, config_name, piece, start_byte, end_byte, start_char, end_char, start_word, end_word, overlap_words, boundary) over ``ranges`` (id, part, left, own, ...), whose bytes ``read`` adds as ``text``."""
    kind = ranges.schema["id"].dataType.simpleString()
    table = stage(ranges.mapInArrow(lambda batches: _scan(read(batches)), f"id {kind}, part bigint, {TABLE}"), label="boundary-table")
    ends = stage(table.repartition("id").sortWithinPartitions("id", "part").mapInArrow(_cut(configs), f"id {kind}, {ENDS}"), label="piece-ends")
    asked = ends.groupBy("id", "part").agg(F.collect_set(F.struct("begins", "nth")).alias("asked"))
    found = ranges.join(asked, ["id", "part"]).mapInArrow(lambda batches: _offsets(read(batches)), f"id {kind}, part bigint, begins boolean, nth bigint, byte bigint, char bigint")
    placed = ends.join(found, ["id", "part", "begins", "nth"]).withColumns({"byte": F.col("part") * range_bytes + F.col("byte"), "char": F.col("chars_before") + F.col("char")})
    side = lambda c, begins: F.max(F.when(F.col("begins") == begins, F.col(c)))
    return placed.groupBy("id", "config_name", "piece", "start_word", "end_word", "overlap_words", "boundary").agg(
        side("byte", True).alias("start_byte"), side("byte", False).alias("end_byte"), side("char", True).alias("start_char"), side("char", False).alias("end_char")
    )


def split(df: DataFrame, keys: list[str], text: str, configs: list[Config], with_text: bool = True, range_bytes: int = RANGE, halo: int = HALO) -> DataFrame:
    """(keys..., config_name, piece, start_char, end_char, start_word, end_word, overlap_words, boundary[, piece_text]): the pieces of each text over a limit.

    Offsets count characters from 0, ends are exclusive; ``boundary`` grades the piece's end.
    """
    configs = [c.checked() for c in configs]
    if halo < HALO or range_bytes < 1:
        raise ValueError(f"a halo of {HALO} bytes at least, and a range of one")
    bound_batches(df.sparkSession)
    extra = ["piece_text"] if with_text else []
    rows = df.select(F.struct(*[F.col(k) for k in keys]).alias("id"), F.col(text).cast("string").alias("text"))
    shape = f"id {rows.schema['id'].dataType.simpleString()}, {PIECE}" + ", piece_text string" * with_text
    small = rows.where(F.octet_length("text") <= range_bytes).mapInArrow(_whole(configs, with_text), shape)
    large = rows.where(F.octet_length("text") > range_bytes).select("id", F.monotonically_increasing_id().alias("row"), F.col("text").cast("binary").alias("raw"))
    large = stage(large, label="long-texts")  # so that a row keeps its number
    size = F.octet_length("raw")
    base = lambda p: p * range_bytes
    left = lambda p: F.least(base(p), F.lit(halo))
    own = lambda p: F.least(size - base(p), F.lit(range_bytes))
    ranges = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / range_bytes).cast("int")),
        lambda p: F.struct(p.cast("bigint").alias("part"), left(p).alias("left"), own(p).alias("own"), F.substring(F.col("raw"), base(p) - left(p) + 1, left(p) + own(p) + halo).alias("text")),
    )
    ranges = large.select(F.col("row").alias("id"), F.explode(ranges).alias("r")).select("id", "r.*").repartition("id", "part")
    pieces = _in_ranges(ranges, lambda batches: batches, configs, range_bytes).withColumnRenamed("id", "row").join(large, "row")
    if with_text:
        pieces = pieces.withColumn("piece_text", F.substring(F.col("raw"), (F.col("start_byte") + 1).cast("int"), (F.col("end_byte") - F.col("start_byte")).cast("int")).cast("string"))
    return small.unionByName(pieces.select("id", *_PIECE, *extra)).select("id.*", *_PIECE, *extra)


def split_files(spark: SparkSession, paths: str | list[str], configs: list[Config], with_text: bool = True, range_bytes: int = FILE_RANGE, halo: int = HALO) -> DataFrame:
    """As ``split``, for UTF-8 files, by path; offsets are bytes. A worker reads its range and halo, or a piece, never a whole file.

    Files must be in a folder that all executors see. Bytes that are not UTF-8 are replaced in the pieces.
    """
    configs = [c.checked() for c in configs]
    if halo < HALO or range_bytes < 1:
        raise ValueError(f"a halo of {HALO} bytes at least, and a range of one")
    bound_batches(spark)
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("id"), F.col("length").alias("size")).where("size > 0")
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / range_bytes).cast("bigint"))).alias("part")
    ranges = files.select("id", "size", part).withColumn("base", F.col("part") * range_bytes)
    ranges = ranges.select("id", "part", "base", F.least("base", F.lit(halo).cast("bigint")).alias("left"), F.least(F.col("size") - F.col("base"), F.lit(range_bytes).cast("bigint")).alias("own"))
    ranges = ranges.repartition("id", "part")

    def at(path: str, begin: int, size: int) -> bytes:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        with system.open_input_file(name) as f:
            return f.read_at(size, begin)

    def read(batches):
        for b in batches:
            for i, (path, base, left, own) in enumerate(zip(*(b.column(x).to_pylist() for x in ("id", "base", "left", "own")))):
                one = b.slice(i, 1)
                yield one.append_column("text", pa.array([at(path, base - left, left + own + halo)], pa.binary()))

    pieces = _in_ranges(ranges, read, configs, range_bytes)
    offsets = [F.col("start_byte").alias("start_char"), F.col("end_byte").alias("end_char")]
    pieces = pieces.select(F.col("id").alias("path"), "config_name", "piece", *offsets, "start_word", "end_word", "overlap_words", "boundary")
    if not with_text:
        return pieces

    def emit(batches):
        for b in batches:
            spans = zip(*(b.column(x).to_pylist() for x in ("path", "start_char", "end_char")))
            yield b.append_column("piece_text", pa.array([at(path, x, y - x).decode("utf-8", "replace") for path, x, y in spans], pa.string()))

    return pieces.mapInArrow(emit, f"path string, {PIECE}, piece_text string")
