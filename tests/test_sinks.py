import pytest

from filigree.operators import graph, retrieval
from filigree.sources import sinks


def test_writers_can_run_again(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert [sinks.write_new(df, path, ["k"]), sinks.write_new(df, path, ["k"]), sinks.write_new(spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string"), path, ["k"])] == [2, 0, 1]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert sinks.write_new(df, path, ["k"], force=True) == 2 and spark.read.parquet(path).count() == 2
    log = str(tmp_path / "log")
    for status in ("started", "done"):
        sinks.append_log(spark, log, "chunk", status, {"a": "1"}, processed=3)
    rows = spark.read.parquet(log).orderBy("created_at").collect()
    assert [r.status for r in rows] == ["started", "done"] and rows[0].context == '{"a":"1"}' and rows[0].records_failed is None


def test_graph_and_vectors(spark, tmp_path):
    nodes = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "B"), ("c", "B")], "id string, label string")
    edges = spark.createDataFrame([("a", "b", "t", 1.0), ("a", "b", "t", 2.0), ("b", "c", "u", 1.0)], "src string, dst string, type string, weight double")
    sinks.save_graph(nodes, edges, str(tmp_path / "g"))
    n, e = sinks.load_graph(spark, str(tmp_path / "g"))
    assert n.count() == 3 and sorted(map(tuple, e.collect())) == [("a", "b", "t", 2.0), ("b", "c", "u", 1.0)]
    assert [tuple(r) for r in graph.match_path(n, e, ["A", "B", "B"], ["t", "u"]).collect()] == [("a", "b", "c")]
    with pytest.raises(ValueError):
        graph.match_path(n, e, ["A"], ["t"])
    labels = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, community int")
    assert [tuple(r) for r in graph.community_relations(labels, e).collect()] == [(1, "t", 1)]
    path = str(tmp_path / "v")
    one = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "id string, embedding array<float>")
    assert sinks.upsert_vectors(one, path, 2) == 2
    assert sinks.upsert_vectors(spark.createDataFrame([("y", [1.0, 1.0]), ("z", [1.0, 0.0])], one.schema), path, 2) == 3
    assert spark.read.parquet(path).where("id = 'y'").first().embedding == [1.0, 1.0]
    with pytest.raises(ValueError):
        sinks.upsert_vectors(one, path, 3)


def test_section_hits_slots_and_lines(spark):
    chunks = spark.createDataFrame([("a", "Item_1A", "some  text"), ("b", "item 1a", "x"), ("c", "7", None)], "id string, section_item string, text string")
    hits = spark.createDataFrame([("a", 0.5), ("b", 0.9), ("c", 1.0)], "id string, score double")
    assert [r.id for r in retrieval.in_section(hits, chunks, "ITEM 1A", 5).collect()] == ["b", "a"]
    rows = lambda p, n: spark.createDataFrame([(f"{p}{i}", float(i)) for i in range(n)], "content string, score double")
    got = [r.kind for r in retrieval.allocate(rows("e", 3), rows("s", 9), rows("r", 9), 10).collect()]
    assert got == ["executive"] + ["summary"] * 5 + ["risk"] * 4
    lines = {r.id: r.line for r in retrieval.formatted(hits, chunks).collect()}
    assert lines["a"] == "[a] score=0.500 some text" and lines["c"] == "[c] score=1.000 "
