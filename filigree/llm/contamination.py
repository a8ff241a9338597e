"""Passages of held-out test items inside a training corpus.

A prefix-filtered set join, verified exactly over windows as long as a stretch.

A leak holds a stretch of at least a third of an item's n words, S = ceil(n/3),
with at most one word in ten changed, dropped or added, and one more for what
the splitting into words may make of markup. A stretch of 2 S words or more
holds a shorter one that qualifies, so lengths from S to 2 S - 1 say it all;
and of the lengths that allow the same number of edits, the least. A stretch of
L words has L - q + 1 shingles of q words, of which E edits spoil at most q E.
So it shares L - q + 1 - q E with the document (the count bound), and one of
its q E + 1 rarest (the necessary prefix). A passage held whole in two
stretches with other text between is bounded in the same way, with q - 1
shingles more spoilt.

1. One pass over the corpus turns texts into numbers of the items' words,
   counts the documents of every shingle, and keeps the numbers of documents
   with as many known shingles as any item's count bound asks for.
2. The counts order the shingles by rarity. Only prefix shingles are looked up
   in the kept documents; the others are compared with the items so found.
3. A pair that meets the count bound within a window of a stretch and its edits
   is decided exactly: windows of the item of whose words enough stand on the
   diagonals of those shingles are aligned, from every word that a stretch may
   begin with to every word that it may end with. A passage in several stretches
   counts when its words stand in the document in its order,
   nine in ten of them, each near a shared shingle.

The test items are the broadcast side, in arrays. They are taken in blocks of
at most ``BLOCK_WORDS`` words, one pass over the corpus for each block, so
nothing that grows is broadcast or collected.

Words are what is left between white space of the consistent form of the text
(see ``canonical``) in lower case, without markup and punctuation.

Defined results: null or blank passages and texts match nothing; items that
share a passage are all reported; repeated document ids are reported once;
short passages take shorter
shingles, so that every stretch shares one.
"""

from __future__ import annotations

import html
import re
import string
from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from filigree.llm.canonical import transducer
from filigree.runtime import bound_batches, stage

SHINGLE = 5
STRETCH = 3
EDITS = 10
SLACK = 1
BLOCK_WORDS = 500_000

_TAG = re.compile(r"</?[A-Za-z!?][^<>]*>")
_SIGNS = re.compile("[\xa1-\xbf‐-⁞]")
_LOWER = bytes(range(256)).translate(bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode()))
_DROP = string.punctuation.encode()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    form = transducer().apply(text)
    if "<" in form:
        form = _TAG.sub(" ", form)
    if "&" in form and ";" in form:
        form = html.unescape(form)
    if not form.isascii():
        form = _SIGNS.sub("", form.lower())
    return form.encode("utf-8", "surrogatepass").translate(_LOWER, _DROP).split()


class Passage:
    """The words of a passage as numbers, and what a qualifying stretch of it must share."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = ids
        n = len(ids)
        self.stretch = -(-n // STRETCH)
        edits = lambda words: words // EDITS + SLACK
        #: (length, edits) of the stretches to look for: of each number of edits the shortest.
        self.lengths = sorted({(max(self.stretch, EDITS * (edits(x) - SLACK)), edits(x)) for x in range(self.stretch, min(n, 2 * self.stretch - 1) + 1)})
        self.edits = edits(n)
        #: The longest shingles of which a stretch must share one at least.
        self.width = q = max([1, *(q for q in range(2, SHINGLE + 1) if all(x - q + 1 - q * e > 0 for x, e in self.lengths))])
        #: Shingles that a stretch, and the passage in two, must share.
        self.bounds = [(max(1, x - q + 1 - q * e), x - q) for x, e in self.lengths]
        self.need = min(b for b, _ in self.bounds)
        self.whole = max(1, n - q + 1 - q * self.edits - (q - 1))
        self.keys = shingles(ids, q)

    def prefix(self, rank: np.ndarray) -> np.ndarray:
        """Whether each shingle is among the rarest, by ``rank``, of a stretch that would have to share one of them."""
        n, q = len(self.keys), self.width
        chosen = np.zeros(n, bool)
        for words, spoilt in [*((x, q * e) for x, e in self.lengths), (len(self.ids), q * self.edits + q - 1)]:
            size = min(n, max(1, words - q + 1))
            view = np.lib.stride_tricks.sliding_window_view(rank, size)
            last = np.partition(view, spoilt, axis=1)[:, spoilt] if spoilt < size else view.max(axis=1)
            for k in range(size):
                chosen[k : k + len(view)] |= view[:, k] <= last
        return chosen


class Index:
    """The different passages of a block, and their shingles by width in arrays."""

    def __init__(self, texts: list[str]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        by_words: dict[bytes, int] = {}
        self.passages: list[Passage] = []
        #: The passage of each text, -1 for those without words.
        self.of_text: list[int] = []
        for text in texts:
            ids = np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)], np.int32)
            if not len(ids):
                self.of_text.append(-1)
                continue
            p = by_words.setdefault(ids.tobytes(), len(self.passages))
            if p == len(self.passages):
                self.passages.append(Passage(ids))
            self.of_text.append(p)
        self.widths = sorted({p.width for p in self.passages})
        self.keys: dict[int, np.ndarray] = {}
        #: By width: where the entries of each shingle begin, their passages and places.
        self.entries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for q in self.widths:
            own = [(p, x.keys) for p, x in enumerate(self.passages) if x.width == q]
            keys = np.concatenate([k for _, k in own])
            by = np.argsort(keys, kind="stable")
            self.keys[q], begin = np.unique(keys[by], return_index=True)
            owner, place = np.concatenate([np.full(len(k), p) for p, k in own]), np.concatenate([np.arange(len(k)) for _, k in own])
            self.entries[q] = np.append(begin, len(keys)), owner[by], place[by]
        self.whole = np.array([p.whole for p in self.passages], np.int64)
        #: Of each passage the bounds of its stretches, the last repeated to make a table: shingles, and places between the first and the last.
        bounds = [p.bounds for p in self.passages]
        deep = max(map(len, bounds), default=0)
        self.bounds = np.array([[*b, *[b[-1]] * (deep - len(b))] for b in bounds], np.int64).reshape(len(bounds), deep, 2)
        self.edits = np.array([p.edits for p in self.passages], np.int64)
        self.least_of = np.array([min(p.need, p.whole) for p in self.passages], np.int64)
        self.least = {q: int(min(min(p.need, p.whole) for p in self.passages if p.width == q)) for q in self.widths}

    def prefixes(self, seen: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """By width: which entries are prefix shingles of their passages; ``seen`` counts the documents of each key."""
        out = {}
        for q in self.widths:
            order = np.lexsort((self.keys[q], seen[q]))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            begin, owner, place = self.entries[q]
            rank = rank[np.repeat(np.arange(len(order)), np.diff(begin))]
            chosen = np.zeros(len(owner), bool)
            by = np.lexsort((place, owner))
            edge = np.flatnonzero(np.concatenate(([True], np.diff(owner[by]) != 0, [True])))
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
                chosen[by[a:z]] = self.passages[owner[by[a]]].prefix(rank[by[a:z]])
            out[q] = chosen
        return out


def shingles(ids: np.ndarray, width: int) -> np.ndarray:
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key = (key ^ ids[k : k + n].astype(np.uint64)) * _MIX
        key ^= key >> np.uint64(29)
    return key


def text_shingles(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of the shingles of a text without word 0, which is no item's word."""
    known = ids > 0
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    run = known[:n].copy()
    for k in range(1, width):
        run &= known[k : k + n]
    at = np.flatnonzero(run)
    key = np.zeros(len(at), np.uint64)
    for k in range(width):
        key = (key ^ ids[at + k].astype(np.uint64)) * _MIX
        key ^= key >> np.uint64(29)
    return key, at


def _among(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``keys`` of those that are among the given ones, and where they stand there."""
    if not len(among) or not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    j = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    hit = np.flatnonzero(among[j] == keys)
    return hit, j[hit]


def _windows(line: np.ndarray, width: int) -> np.ndarray:
    return np.lib.stride_tricks.as_strided(line, (len(line) - width + 1, width), line.strides * 2, writeable=False)


def leaks(passage: Passage, text: np.ndarray, at_item: np.ndarray, at_text: np.ndarray) -> bool:
    """Whether a text that shares shingles at the given places holds the passage or a third of it."""
    n = len(passage.ids)
    # diagonals that lie with as many shingles as a stretch must share, and windows of the passage that have words enough beside them
    line = np.sort(at_text - at_item)
    last = np.searchsorted(line, line + passage.edits, "right") - 1
    first = np.flatnonzero(last - np.arange(len(line)) + 1 >= passage.need)
    low, high = line[last[first]] - passage.edits, line[first] + passage.edits + 1
    cuts = np.flatnonzero(low[1:] > high[:-1])
    for d, end in zip(low[[0, *(cuts + 1)]].tolist(), high[[*cuts, len(high) - 1]].tolist()) if len(first) else ():
        a, z = max(0, 1 - end), min(n, len(text) - d)
        if z <= a:
            continue
        beside = text[max(0, a + d) : z + end - 1]
        before, after = max(0, -(a + d)), max(0, z + end - 1 - len(text))
        if before or after:
            beside = np.concatenate((np.full(before, -1, np.int32), beside, np.full(after, -1, np.int32)))
        met = np.zeros(z - a + 1, np.int64)
        np.cumsum((_windows(beside, end - d) == passage.ids[a:z, None]).any(axis=1), out=met[1:])
        if any(z - a >= x and (met[x:] - met[:-x]).max() >= x - e for x, e in passage.lengths):
            own = np.unique(line[(line >= d) & (line < end)])
            if any(_along(passage, text, x) for x in own.tolist()) or _stretch(passage, text, d, end):
                return True
    return _in_order(passage, text, at_item, at_text)


def _along(passage: Passage, text: np.ndarray, d: int) -> bool:
    """Whether a stretch stands word for word along a diagonal, with words changed only."""
    a, z = max(0, -d), min(len(passage.ids), len(text) - d)
    same = passage.ids[a:z] == text[a + d : z + d]
    wrong = np.concatenate(([0], np.cumsum(~same)))
    return any(z - a >= x and ((wrong[x:] - wrong[:-x] <= e) & same[: z - a - x + 1] & same[x - 1 :]).any() for x, e in passage.lengths)


def _stretch(passage: Passage, text: np.ndarray, low: int, high: int) -> bool:
    """Whether an alignment that begins and ends with equal words, and begins on a diagonal from ``low`` to ``high``, is long enough for its edits: from every such beginning, the edit distances in a band."""
    n, most = len(passage.ids), passage.edits
    begins = []
    for d in range(low, high):
        a, z = max(0, -d), min(n - passage.stretch + 1, len(text) - d)
        if z > a:
            i = np.flatnonzero(passage.ids[a:z] == text[a + d : z + d]) + a
            begins.append(np.stack((i, i + d)))
    if not begins:
        return False
    base = max(0, low)
    text = text[base : high + n + most]
    begins = np.concatenate(begins, axis=1)
    band = np.arange(2 * most + 1, dtype=np.int32)
    padded = np.concatenate((np.full(most, -1, np.int32), text, np.full(n + most + 1, -1, np.int32)))
    for lo in range(0, begins.shape[1], 4096):
        i, j = begins[0, lo : lo + 4096], begins[1, lo : lo + 4096] - base
        # distance of the words taken so far to as many words of the text, less ``most`` and one more for each column
        far = np.broadcast_to(np.where(band >= most, band - most, n), (len(i), len(band))).astype(np.int32)
        for taken in range(1, n):
            alive = (i + taken < n) & (far.min(axis=1) <= (n - i) // EDITS + SLACK)
            if not alive.any():
                break
            i, j, far = i[alive], j[alive], far[alive]
            same = passage.ids[i + taken][:, None] == padded[(j + taken)[:, None] + band]
            across = far + ~same
            if taken + 1 >= passage.stretch and (same & (far <= (taken + 1) // EDITS + SLACK)).any():
                return True
            down = np.concatenate((far[:, 1:], np.full((len(far), 1), n, np.int32)), axis=1) + 1
            best = np.minimum(across, down)
            far = np.minimum.accumulate(best - band, axis=1) + band
    return False


def _in_order(passage: Passage, text: np.ndarray, at_item: np.ndarray, at_text: np.ndarray) -> bool:
    """Whether nine words in ten of the passage stand in the text in order, each no further from a shared shingle than its edits allow."""
    n, q, edits = len(passage.ids), passage.width, passage.edits
    least = n - edits
    if np.count_nonzero(np.bincount(at_item)) < passage.whole:
        return False
    # shared shingles in order
    tails: list[int] = []
    for k in np.lexsort((-at_item, at_text)).tolist():
        at = bisect_left(tails, at_item[k])
        tails[at : at + 1] = [int(at_item[k])]
    if len(tails) < passage.whole:
        return False
    reach, wide = q * (edits + 1), edits + 1
    near = {(x, y) for x, y in np.unique(np.stack((at_text // reach, (at_text - at_item) // wide), axis=1), axis=0).tolist()}
    where: dict[int, list[int]] = {}
    for i, w in enumerate(passage.ids.tolist()):
        where.setdefault(w, []).append(i)
    zone = np.zeros(len(text) + 1, np.int64)
    np.add.at(zone, np.maximum(at_text - reach, 0), 1)
    np.add.at(zone, np.minimum(at_text + reach, len(text)), -1)
    tails = []  # least last word of an ascending chain of each length
    for j in np.flatnonzero(np.cumsum(zone[:-1]) > 0).tolist():
        for i in reversed(where.get(int(text[j]), ())):
            x, y = j // reach, (j - i) // wide
            if any((x + s, y + t) in near for s in (0, -1, 1) for t in (0, -1, 1)):
                k = bisect_left(tails, i)
                tails[k : k + 1] = [i]
    return len(tails) >= least


def _numbers(texts: list[str | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Words of many texts as numbers in one line, a 0 after each text, and where each begins."""
    get = vocabulary.get
    line: list[int] = []
    starts = []
    for t in texts:
        starts.append(len(line))
        if t:
            line += [get(w, 0) for w in words(t)]
        line.append(0)
    return np.array(line, np.int32), np.array([*starts, len(line)], np.int64)


#: Entries of shared shingles, and words of texts, that a worker looks at together.
ENTRIES, WORDS_AT_ONCE = 1 << 20, 1 << 17


def _expanded(begin: np.ndarray, which: np.ndarray):
    """Entries of the shingles ``which``, in slices of bounded length: (positions in ``which``, entries)."""
    copies = begin[which + 1] - begin[which]
    total = np.concatenate(([0], np.cumsum(copies)))
    lo = 0
    while lo < len(which):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + ENTRIES, "right")) - 1)
        at = np.repeat(np.arange(lo, hi), copies[lo:hi])
        yield at, begin[which[at]] + np.arange(total[lo], total[hi]) - total[at]
        lo = hi


_FAR = 1 << 31
_PLACES = 1 << 24


def _is_in(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are among the given ones, which ascend."""
    if not len(among):
        return np.zeros(len(keys), bool)
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys


def _within_bounds(group: np.ndarray, at_item: np.ndarray, diagonal: np.ndarray, shift: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The groups of shared shingles of which as many as a stretch must share stand as close as it lets them, in the passage and by diagonal."""
    # any diagonals that are close enough lie in one of the bands, each twice as wide as that and half over the next
    band = (diagonal + _FAR // 2) // (shift[group] + 1)
    g, band, at = np.concatenate((group, group)), np.concatenate((band, band - 1)), np.concatenate((at_item, at_item))
    order = np.lexsort((at, band, g))
    g, band, at = g[order], band[order], at[order]
    new = np.concatenate(([True], (np.diff(g) != 0) | (np.diff(band) != 0))) if len(g) else np.zeros(0, bool)
    once = new.copy()
    once[1:] |= np.diff(at) != 0
    g, at, new = g[once], at[once], new[once]
    run = np.cumsum(new)
    out = np.zeros(len(shift), bool)
    for k in range(bounds.shape[1]):
        need, reach = bounds[g, k, 0], bounds[g, k, 1]
        last = np.minimum(np.arange(len(g)) + need - 1, len(g) - 1)
        good = (np.arange(len(g)) + need <= len(g)) & (run[last] == run) & (at[last] - at <= reach)
        out[g[good]] = True
    return out


def find(index: Index, prefixes: dict[int, np.ndarray], ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """(text, passage) of the leaks in texts that stand in one line."""
    out = []
    passages = len(index.passages)
    for q, chosen in prefixes.items():
        begin, owner, place = index.entries[q]
        keys, at = text_shingles(ids, q)
        hit, which = _among(keys, index.keys[q])
        at = at[hit]
        doc = np.searchsorted(starts, at, "right") - 1
        # pairs that share a prefix shingle; only shingles that are one for some passage are looked up
        rare = np.flatnonzero(np.logical_or.reduceat(chosen, begin[:-1])[which])
        pairs = [np.zeros(0, np.int64)]
        for x, entry in _expanded(begin, which[rare]):
            x, entry = x[chosen[entry]], entry[chosen[entry]]
            pairs.append(np.unique(doc[rare[x]] * passages + owner[entry]))
        pairs = np.unique(np.concatenate(pairs))
        # all shared shingles of these pairs
        some = np.flatnonzero(np.isin(doc, pairs // passages))
        got = [(np.zeros(0, np.int64),) * 3]
        for x, entry in _expanded(begin, which[some]):
            pair = doc[some[x]] * passages + owner[entry]
            among, _ = _among(pair, pairs)
            x = some[x[among]]
            got.append((pair[among], at[x] - starts[doc[x]], place[entry[among]]))
        pair, at_text, at_item = (np.concatenate(v) for v in zip(*got))
        # different places of the passage first
        line = np.sort(pair * _PLACES + at_item)
        names, n = np.unique(line[np.diff(line, prepend=-1) != 0] // _PLACES, return_counts=True)
        enough = _is_in(pair, names[n >= index.least_of[names % passages]])
        pair, at_text, at_item = pair[enough], at_text[enough], at_item[enough]
        order = np.argsort(pair, kind="stable")
        pair, at_text, at_item = pair[order], at_text[order], at_item[order]
        edge = np.flatnonzero(np.concatenate(([True], np.diff(pair) != 0, [True]))) if len(pair) else np.zeros(1, np.int64)
        group = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        p = pair[edge[:-1]] % passages
        likely = _within_bounds(group, at_item, at_text - at_item, index.edits[p], index.bounds[p])
        likely |= np.bincount(np.unique(group * _FAR + at_item) // _FAR, minlength=len(p)) >= index.whole[p]
        chosen_groups = np.flatnonzero(likely)
        for g in chosen_groups[np.argsort(p[chosen_groups], kind="stable")].tolist():
            a, z = edge[g], edge[g + 1]
            d, own = divmod(int(pair[a]), passages)
            if leaks(index.passages[own], ids[starts[d] : starts[d + 1] - 1], at_item[a:z], at_text[a:z]):
                out.append((d, own))
    return out


def _pass(df: DataFrame, key: str, text: str, items: list, index: Index, item_type) -> DataFrame:
    rows = df.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).where("text is not null and doc is not null")
    context = df.sparkSession.sparkContext
    shared = context.broadcast(index)
    kind = df.schema[key].dataType.simpleString()

    def read(batches):
        """Documents worth a closer look, as numbers, and for each batch a count of documents by shingle."""
        index = shared.value
        total = {q: np.zeros(len(k), np.int64) for q, k in index.keys.items()}
        doc_type = None
        for b in batches:
            doc_type = b.column("doc").type
            ids, starts = _numbers(b.column("text").to_pylist(), index.vocabulary)
            n = len(starts) - 1
            kept = np.zeros(n, bool)
            for q, keys in index.keys.items():
                got, at = text_shingles(ids, q)
                hit, which = _among(got, keys)
                doc = np.searchsorted(starts, at[hit], "right") - 1
                total[q] += np.bincount(np.unique(doc * len(keys) + which) % len(keys), minlength=len(keys))
                kept |= np.bincount(doc, minlength=n) >= index.least[q]
            at = np.flatnonzero(kept)
            none = pa.nulls(len(at), pa.int64())
            yield pa.record_batch([b.column("doc").take(pa.array(at)), pa.array([ids[starts[i] : starts[i + 1]].tobytes() for i in at.tolist()], pa.binary()), none, none, none], ["doc", "ids", "width", "at", "n"])
        if doc_type is not None:
            for q, n in total.items():
                at = np.flatnonzero(n)
                yield pa.record_batch([pa.nulls(len(at), doc_type), pa.nulls(len(at), pa.binary()), pa.array(np.full(len(at), q), pa.int64()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["doc", "ids", "width", "at", "n"])

    looked = stage(rows.mapInArrow(read, f"doc {kind}, ids binary, width bigint, at bigint, n bigint"), label="texts-with-known-shingles")
    counts = looked.where("width is not null").groupBy("width", "at").agg(F.sum("n").alias("n")).toArrow()  # at most a line of three numbers for each shingle of the block
    width, at, n = (counts.column(c).to_numpy() for c in ("width", "at", "n"))
    seen = {}
    for q, keys in index.keys.items():
        seen[q] = np.zeros(len(keys), np.int64)
        seen[q][at[width == q]] = n[width == q]
    needed = context.broadcast(index.prefixes(seen))
    held: list[list] = [[] for _ in index.passages]
    for item, p in zip(items, index.of_text):
        if p >= 0:
            held[p].append(item)
    arrow = to_arrow_type(item_type)

    def search(batches):
        index, prefixes = shared.value, needed.value
        for b in batches:
            texts = [np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()]
            edge = np.cumsum([0, *map(len, texts)])
            pairs = []
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + WORDS_AT_ONCE, "right")) - 1)
                found = find(index, prefixes, np.concatenate(texts[lo:hi]), edge[lo : hi + 1] - edge[lo])
                pairs += [(lo + d, item) for d, p in found for item in held[p]]
                lo = hi
            docs, names = zip(*pairs) if pairs else ((), ())
            yield pa.record_batch([b.column("doc").take(pa.array(docs, pa.int64())), pa.array(names, arrow)], ["doc", "item"])

    return looked.where("width is null").select("doc", "ids").mapInArrow(search, f"doc {kind}, item {item_type.simpleString()}")


def contaminated(docs: DataFrame, items: DataFrame, doc_key: str, text: str, item_key: str, passage: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc, item): every document that holds an item's passage, or a stretch of a third of it, with the item; keys of any type."""
    bound_batches(docs.sparkSession)
    item_type = items.schema[item_key].dataType
    items = items.select(F.col(item_key).alias("item"), F.col(passage).cast("string").alias("passage")).where("item is not null and passage is not null").distinct()
    size = items.agg(F.sum(F.size(F.split("passage", r"\s+")))).first()[0] or 0
    blocks = -(-size // block_words) or 1
    parts = []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("passage"), F.lit(blocks)) == b).collect()
        parts.append(_pass(docs, doc_key, text, [r.item for r in own], Index([r.passage for r in own]), item_type))
    return reduce(DataFrame.unionByName, parts).distinct()
