import numpy as np

from filigree.llm import neighbors as V


def _clustered(n, dim=16, seed=0, members=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // members, dim))
    x = np.repeat(centres, members, axis=0) + 0.25 * rng.standard_normal((n // members * members, dim))
    return (x * rng.uniform(0.3, 3, (len(x), 1))).astype(np.float32)


def _brute(x, k):
    u = x.astype(np.float64) / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1, kind="stable")[:, :k]


def _run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "id string, vec array<float>, class string, rank int")
    got = {}
    for r in V.neighbours(df, "id", "vec", **kw).collect():
        got.setdefault(r.key, {})[r["rank"]] = (r.other, r.cosine)
    return got


def test_recall_against_brute_force(spark):
    x = _clustered(3000)
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)]
    want = _brute(x, 5)
    for kw in ({}, {"cell_rows": 100}):
        got = _run(spark, rows, **kw)
        hits = sum(f"v{j:05d}" in {o for o, _ in got[f"v{i:05d}"].values()} for i in range(len(x)) for j in want[i])
        assert hits / want.size > 0.97
        assert all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())


def test_blocks_of_a_hot_cell_lose_nothing(spark):
    x = _clustered(600, seed=3)
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)]
    assert {k: {o for o, _ in v.values()} for k, v in _run(spark, rows, cell_rows=40).items()} == {k: {o for o, _ in v.values()} for k, v in _run(spark, rows).items()}


def test_unusable_repeated_and_equal_vectors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [1.0, 0.0]), ("d", [0.0, 1.0]), ("z", [0.0, 0.0]), ("n", None), ("e", []), ("w", [1.0, 2.0, 3.0]), ("q", [float("nan"), 1.0]), ("p", [None, 1.0]), ("a", [1.0, 0.0]), (None, [1.0, 1.0])]
    got = _run(spark, rows, k=2)
    assert set(got) == {"a", "b", "c", "d"}
    assert [o for o, _ in got["a"].values()] == ["b", "c"] and got["a"][1][1] == 1.0
    assert [o for o, _ in (got["b"][1], got["b"][2])] == ["a", "c"]


def test_many_equal_vectors(spark):
    rows = [(f"e{i:03d}", [1.0, 1.0, 0.5]) for i in range(200)] + [("x", [1.0, 1.0, 0.4])]
    got = _run(spark, rows, k=3)
    assert [got["e000"][r][0] for r in (1, 2, 3)] == ["e001", "e002", "e003"]
    assert [got["e150"][r][0] for r in (1, 2, 3)] == ["e000", "e001", "e002"]
    assert [got["x"][r][0] for r in (1, 2, 3)] == ["e000", "e001", "e002"]


def test_empty_and_single(spark):
    assert _run(spark, []) == {} and _run(spark, [("a", [1.0, 2.0])]) == {}


def test_probing_order_is_ascending_and_valid():
    order = V.probing_order(4, 1.2, 60)
    assert order[0] == () and len(set(order)) == len(order)
    assert all(7 - r not in s for s in order for r in s)


def test_outliers_find_as_many_as_there_are(spark):
    """Vectors that stand alone may meet nobody in their buckets."""
    rng = np.random.default_rng(4)
    x = np.concatenate((_clustered(1200, seed=6), 3 * rng.standard_normal((40, 16)))).astype(np.float32)
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)]
    got = _run(spark, rows, bucket_rows=1, probes=2)
    assert len(got) == len(x) and all(len(v) == 5 for v in got.values())


def test_lonely_vectors_are_compared_with_all():
    import pyarrow as pa

    x = _clustered(600, seed=3)
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    of = np.arange(0, len(x), 7)
    batches = [pa.record_batch([pa.array(np.arange(lo, min(lo + 50, len(x)))), pa.array([v.tobytes() for v in unit[lo : lo + 50]], pa.binary())], ["class", "vector"]) for lo in range(0, len(x), 50)]
    [out] = V._against_all(of, unit[of], 16, 5)(iter(batches))
    got = {}
    for a, b in zip(out.column("class").to_pylist(), out.column("other").to_pylist()):
        got.setdefault(a, set()).add(b)
    want = _brute(x, 5)
    assert got == {int(i): set(want[i].tolist()) for i in of}


def test_small_lots_change_nothing(spark, monkeypatch):
    x = _clustered(600, seed=3)
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)]
    whole = _run(spark, rows)
    t = V.Tables(16, 2, 3, 1, 1.2, 20, 7)
    import pyarrow as pa

    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    batch = pa.record_batch([pa.array(np.arange(len(x))), pa.array([v.tobytes() for v in unit.astype(np.float32)], pa.binary())], ["class", "vector"])
    [sent] = [pa.Table.from_batches(list(V._scatter(t, {})(iter([batch]))))]
    sent = sent.sort_by([("table", "ascending"), ("cell", "ascending"), ("s", "ascending"), ("u", "ascending")])
    out = []
    for rows_at_once, size in ((10**9, 10**6), (50, 37)):
        monkeypatch.setattr(V, "ROWS_AT_ONCE", rows_at_once)
        monkeypatch.setattr(V, "PROBE_BYTES", 1 << 20 if rows_at_once > 50 else 2000)
        out.append({(a, b) for r in V._search(t, 5)(iter(sent.to_batches(max_chunksize=size))) for a, b in zip(r.column("class").to_pylist(), r.column("other").to_pylist())})
    assert out[0] == out[1] and whole
