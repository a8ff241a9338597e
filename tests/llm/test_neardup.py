import random
import re

import numpy as np

from filigree.llm import neardup as N

WORDS = [f"word{i}" for i in range(3000)]


def _jaccard(a, b, width):
    sets = []
    for t in (a, b):
        w = re.findall(r"[a-z0-9]+", re.sub(r"<[^>]*>", "", t).lower())
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def _corpus(seed=1, bases=25, copies=4):
    rng = random.Random(seed)
    texts = {}
    for b in range(bases):
        base = rng.choices(WORDS, k=rng.randint(40, 200))
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, len(w) // 8)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts[f"t{b}-{c}"] = " ".join(w)
    return texts


def _expected(texts, threshold, width, least=30):
    names = sorted(k for k, t in texts.items() if t and len(re.findall(r"[a-z0-9]+", re.sub(r"<[^>]*>", "", t).lower())) >= least)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if _jaccard(texts[a], texts[b], width) >= threshold}


def _found(spark, texts, **kw):
    df = spark.createDataFrame([(k, t, "x", 5) for k, t in texts.items()], "k string, text string, class string, bucket int")
    nd = N.near_duplicates(df, ["k"], "text", **kw)
    return nd, {(r.id_a.k, r.id_b.k) for r in nd.pairs().collect()}


def test_pairs_match_brute_force(spark):
    texts = _corpus()
    texts |= {"copy": texts["t0-0"], "markup": texts["t1-0"].replace(" ", " <b x='1'>", 1).upper(), "null": None, "empty": "", "short": "a b c", "edge": " ".join(WORDS[:30]), "edge2": " ".join(WORDS[:30]) + "."}
    for kw in (dict(threshold=0.6, width=3), dict(threshold=0.8, width=5)):
        nd, got = _found(spark, texts, **kw)
        assert got == _expected(texts, kw["threshold"], kw["width"])
    members = {r.k: r for r in nd.classes().collect()}
    assert members["copy"]["class"] == members["t0-0"]["class"] and members["copy"].copies == 2
    assert "null" not in members and "short" not in members


def test_hot_bucket_in_blocks_loses_nothing(spark):
    rng = random.Random(5)
    base = rng.choices(WORDS, k=120)
    texts = {}
    for c in range(60):
        w = list(base)
        for _ in range(rng.randint(1, 10)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts[f"h{c:02d}"] = " ".join(w)
    want = _expected(texts, 0.6, 3)
    blocks, whole = (_found(spark, texts, threshold=0.6, width=3, **kw)[1] for kw in ({"bucket_rows": 7}, {}))
    assert blocks == whole <= want and len(whole) >= 0.99 * len(want)


def test_kinds_stay_apart_and_repeated_keys(spark):
    t = _corpus(bases=1, copies=1)["t0-0"]
    df = spark.createDataFrame([("a", "1", t), ("a", "2", t), ("b", "1", t), ("a", "1", t)], "kind string, k string, text string")
    got = N.near_duplicates(df, ["kind", "k"], "text", within=["kind"]).pairs().collect()
    assert [(r.id_a.k, r.id_b.k, r.id_a.kind) for r in got] == [("1", "2", "a")]


def test_empty_table_and_very_long_text(spark):
    assert _found(spark, {})[1] == set()
    rng = random.Random(2)
    long = rng.choices(WORDS, k=120_000)
    other = long[:60_000] + ["changed"] + long[60_000:]
    assert _found(spark, {"a": " ".join(long), "b": " ".join(other)})[1] == {("a", "b")}


def test_trie_join_is_exact():
    rng = np.random.default_rng(0)
    marks = rng.integers(0, 1 << 63, (300, 2), np.uint64)
    for i in range(0, 300, 3):
        marks[i + 1] = marks[i] ^ np.uint64(1 << int(rng.integers(0, 60)))
    marks = marks[np.lexsort((marks[:, 1], marks[:, 0]))]
    flat = lambda n: np.full(129, n)
    for most in (0, 1, 40, 60):
        z, walk = np.array([0]), N.Walk()
        got = {(min(a, b), max(a, b)) for i, j in N.trie_join(z, z + 300, z, z + 300, marks, flat(most), wide=50, walk=walk) for a, b in zip(i.tolist(), j.tolist())}
        want = {(a, b) for a in range(300) for b in range(a + 1, 300) if int(np.bitwise_count(marks[a] ^ marks[b]).sum()) <= most}
        assert got == want and walk.left == len(want)
        # few pairs of leaves meet where the budget is small
        assert most > 1 or (walk.compared < 3000 and walk.dropped > 0)
    got = {(a, b) for i, j in N.trie_join(np.array([0]), np.array([100]), np.array([100]), np.array([300]), marks, flat(60)) for a, b in zip(i.tolist(), j.tolist())}
    assert got == {(a, b) for a in range(100) for b in range(100, 300) if int(np.bitwise_count(marks[a] ^ marks[b]).sum()) <= 60}


def test_budgets_grow_with_depth():
    b = N.budgets(0.6)
    assert len(b) == N.BITS + 1 and b[0] == 0 and (np.diff(b) >= 0).all() and (b <= np.arange(N.BITS + 1)).all() and 70 < b[-1] < 90
    rng = np.random.default_rng(1)
    # sets of 400 that share three in five of what either holds, and sets that share one in five
    differ = {}
    for shared in (300, 134):
        both = rng.integers(0, 1 << 63, (200, 800 - shared), np.uint64)
        marks = [[np.frombuffer(N.sketch(N.sign(x)), np.uint8) for x in (r[:400], r[400 - shared :])] for r in both]
        differ[shared] = np.array([np.bitwise_count(p ^ q).sum() for p, q in marks])
    assert (differ[300] <= b[-1]).all() and (differ[134] > b[-1]).mean() > 0.9


def test_subtries_that_go_over_batches(spark, monkeypatch):
    texts = _corpus(seed=9, bases=6, copies=9)
    want = _expected(texts, 0.6, 3)
    monkeypatch.setattr(N, "ROWS_AT_ONCE", 5)
    work = N._join(N.budgets(0.6))
    sets = N._sets(3, 30, None)
    import pyarrow as pa

    names = sorted(texts)
    [rows] = sets([pa.record_batch([pa.array(names), pa.array([""] * len(names)), pa.array([texts[n] for n in names])], ["id", "within", "text"])])
    entries = sorted((p, c, s) for p, c, s in ((p, c, s) for ps, c, s in zip(rows.column("paths").to_pylist(), rows.column("class").to_pylist(), rows.column("sketch").to_pylist()) for p in ps))
    zero = lambda n: pa.array([0] * n, pa.int32())
    batch = lambda e: pa.record_batch([pa.array([x[0] for x in e]), zero(len(e)), zero(len(e)), zero(len(e)), pa.array([x[1] for x in e]), pa.array([x[2] for x in e])], ["path", "x", "y", "own", "class", "sketch"])
    name = dict(zip(rows.column("class").to_pylist(), rows.column("id").to_pylist()))
    got = {tuple(sorted((name[a], name[b]))) for out in work(batch(entries[i : i + 3]) for i in range(0, len(entries), 3)) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist())}
    assert want <= got
