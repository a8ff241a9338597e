import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filigree.llm import packing as P


def _check(counts, spec):
    plan = P.plan(counts, spec)
    boxes, seen = {}, {}
    for r in plan.runs:
        for i in range(r.count):
            box, nth = r.container + i // r.copies, i % r.copies
            boxes.setdefault(box, []).append((r.slot + nth, r.offset + nth * (r.length + spec.separator), r.length))
        seen.setdefault(r.length, []).append((r.rank, r.count))
    assert len(boxes) == plan.containers
    for parts in boxes.values():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        at = 0
        for _, offset, length in parts:
            assert offset == at
            at += length + spec.separator
        assert at - spec.separator <= spec.capacity
    for length, spans in seen.items():
        at = 0
        for rank, count in sorted(spans):
            assert rank == at
            at += count
        assert at == counts[length]
    return plan


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25), st.integers(0, 3))
def test_plan_holds_every_text_once(counts, separator):
    _check(counts, P.Spec("x", 40, separator))


def test_little_room_is_left():
    rng = random.Random(3)
    counts = {}
    for _ in range(20_000):
        n = min(1024, max(5, int(rng.lognormvariate(5.7, 0.7))))
        counts[n] = counts.get(n, 0) + 1
    plan = _check(counts, P.Spec("x", 1024, 1))
    assert plan.unused / (plan.containers * 1024) < 0.01


def test_bad_input_is_refused():
    with pytest.raises(ValueError):
        P.plan({50: 1}, P.Spec("x", 40))
    with pytest.raises(ValueError):
        P.pack(None, "k", "t", [P.Spec("x", 0)])


def test_pack_table(spark):
    rows = [(i, "word " * (i % 50)) for i in range(500)] + [(1000, "word " * 900), (1001, None), (1002, ""), (1, "word " * 1)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "key bigint, text string, spec string, rank string")
    specs = [P.Spec("s", 64, 1), P.Spec("t", 200, 0)]
    out = P.pack(df, "key", "text", specs).toPandas()
    for s in specs:
        own = out[out.spec_name == s.name]
        whole = own.groupby("key").n_tokens.sum()
        assert set(own.key) == {r[0] for r in rows}
        assert own[own.key == 1001].container_id.isna().all() and own[own.key == 1002].container_id.isna().all()
        placed = own[own.container_id.notna()].sort_values(["container_id", "slot"])
        for _, box in placed.groupby("container_id"):
            assert list(box.slot) == list(range(len(box)))
            assert (box.token_offset + box.n_tokens).max() <= s.capacity
        split = own[own.piece_no > 0].key.unique()
        assert all(whole[k] > s.capacity for k in split)
        big = own[own.key == 1000].sort_values("piece_no")
        assert (big.n_tokens[:-1] == s.capacity).all() and list(big.token_start) == [i * s.capacity for i in range(len(big))]
    report = {r.spec_name: r.used for r in P.fill_report(spark.createDataFrame(out[out.container_id.notna()].astype({"container_id": "int64", "token_offset": "int64"})), specs).collect()}
    assert report["s"] > 0.95 and report["t"] > 0.95


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "key bigint, text string"), "key", "text", [P.Spec("s", 64)]).count() == 0
