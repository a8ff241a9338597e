import datetime
import json

import pytest
from pyspark.sql import functions as F

from filigree.functions import identity, text
from filigree.operators import blocks, entities, graph, passages, quality, retrieval, routing, sections, upsert
from filigree.sources import documents, xbrl
from filigree.streaming import ingest


def _rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# table changes


def test_upsert_keeps_and_overwrites(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", None), (None, "n", "n")], "k string, o string, c string")
    new = spark.createDataFrame([("1", "A", None), ("3", "N", "z"), (None, None, "m")], "k string, o string, c string")
    assert sorted(map(str, _rows_any(upsert.upsert(old, new, ["k"], ["o"], ["c"])))) == sorted(map(str, [("1", "A", "x"), ("2", "b", None), ("3", "N", "z"), (None, None, "m")]))


def _rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_patch_absent_gated_replaced(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k int, s string, n int")
    assert _rows(upsert.patch(base, spark.createDataFrame([(2, "z", None), (9, "q", 9)], "k int, s string, n int"), ["k"])) == [(1, "a", 1), (2, "z", 2)]
    new = spark.createDataFrame([(1, "x", 5), (3, "y", 6), (3, "w", 7)], "k int, s string, n int")
    assert _rows(upsert.absent(base, new, ["k"], [F.col("n")])) == [(3, "y", 6)]
    old = spark.createDataFrame([(None, 0.9, 1), (2, 0.5, 1)], "k int, conf double, seq int")
    more = spark.createDataFrame([(None, 0.9, 2), (2, 0.4, 3)], "k int, conf double, seq int")
    assert sorted(map(str, _rows_any(upsert.gated(old, more, ["k"], "conf", "seq")))) == sorted(map(str, [(None, 0.9, 2), (2, 0.5, 1)]))
    assert _rows(upsert.replaced(base.na.fill("-"), spark.createDataFrame([(1, "new", 0)], "k int, s string, n int"), ["k"])) == [(1, "new", 0), (2, "-", 2)]
    assert _rows(upsert.absent(base.limit(0), new.limit(0), ["k"], [F.col("n")])) == []


# functions


def test_identity(spark):
    df = spark.createDataFrame([(" ab ", "00012", "000190000020000001"), ("BRK-B", "abc", "0001900000-95-000001"), ("too long ticker", None, "x")], "t string, c string, a string")
    got = df.select(identity.ticker(F.col("t")), identity.padded_cik(F.col("c")), identity.dashed_accession(F.col("a")), identity.accession_year(identity.dashed_accession(F.col("a")))).collect()
    assert [tuple(r) for r in got] == [("AB", "0000000012", "0001900000-20-000001", "2020"), ("BRK-B", None, "0001900000-95-000001", "1995"), (None, None, "x", "unknown")]
    r = spark.range(1).select(identity.chunk_id(F.lit("a"), F.lit("item 1a"), F.lit(7)), identity.context_prefix(F.lit("T"), F.lit("2020-01-01"), F.lit("1A")), identity.document_url("u", F.lit("0012"), F.lit("1-2"), F.lit("d.htm"))).first()
    assert tuple(r) == ("a_ITEM1A_0007", "Company: T | Filing: 10-K 2020-01-01 | Section: 1A", "u/12/12/d.htm")


def test_text(spark):
    df = spark.createDataFrame([("  a  b\tc\n",), ("",), (None,)], "t string")
    assert [tuple(r) for r in df.select(text.word_count(F.col("t")), text.token_estimate(F.col("t"))).collect()] == [(3, 3), (0, 0), (0, 0)]
    r = spark.range(1).select(text.camel_label(F.lit("NetResult")), text.severity_score(F.lit(0)), text.hop_decay(F.lit(1.0), F.lit(2)), text.tagged_body(F.lit("<TYPE>10-K <TEXT>x</TEXT>")), text.ticker_like(F.lit("AB and CD, X"), ["CD"])).first()
    assert (r[0], r[1], round(r[2], 6), r[3], r[4]) == ("Net Result", 0.6, 0.7225, "x", ["AB"])
    assert spark.range(1).select(text.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None


# documents


def test_blocks():
    limits = blocks.Limits(most=10, overlap=3, least=3, per_word=1.0)
    para = lambda n, w="p": " ".join([w] * n)
    table = "<table><tr><td>" + para(12, "t") + "</td></tr></table>"
    got = blocks.fold("\n\n".join([para(4), para(4, "q"), para(2, "r"), para(5, "s"), table, para(2, "u")]), limits)
    assert [(t.split()[0], n, table) for t, n, table in got] == [("p", 10, False), ("r", 7, False), ("<table><tr><td>t", 12, True)]
    assert blocks.fold(para(30), limits) == [(para(30), 30, False)] and blocks.fold("a b", limits) == [] and blocks.fold("", limits) == []
    small = blocks.fold("<table><td>x</td></table>", limits)
    assert small[0][2] is True


def test_chunk_table(spark):
    df = spark.createDataFrame([(1, "a b c " * 40, "x"), (2, None, "x"), (3, "few words", "x")], "id int, markdown string, key string")
    assert _rows(blocks.chunk(df, "id", "markdown"), "key", "token_count") == [(1, 159)]
    assert blocks.chunk(df.limit(0), "id", "markdown").count() == 0


REPORT = "Contents\nITEM 1. Business\n\nWe make things of many kinds.\n\nITEM 1A. Risk Factors\n\nThings may break at any time.\n\nITEM 7. Management's Discussion\n\nSales grew by a lot this year."


def test_sections(spark):
    text_, how = sections.find(REPORT, "ITEM 1A")
    assert text_.startswith("ITEM 1A. Risk Factors") and "Sales" not in text_ and how == "standard"
    assert sections.find("# Overview\nA long text about the business.\n", "1")[1] == "heading"
    cross = "Form 10-K Cross-Reference Index\nItem 3 page 9 Legal Matters\n\n# Legal Matters\nNothing to report here at all.\n"
    assert sections.find(cross, "3")[1] == "cross_reference" and sections.find(REPORT, "3") is None and sections.find(None, "1") is None
    df = spark.createDataFrame([(1, REPORT), (2, "no such lines"), (3, None)], "id int, md string")
    got = sections.split_at_items(df, "id", "md").orderBy("key", "part").collect()
    assert [(r.key, r.item) for r in got] == [(1, "1"), (1, "1A"), (1, "7"), (2, None)]
    assert _rows(sections.extract(df, "id", "md", ["1", "7"]), "key", "item") == [(1, "1"), (1, "7")]


def test_html_as_markdown(spark):
    page = "<html><head><title>x</title><style>p{}</style></head><body><h2>Risk &amp; more</h2><p>One <b>two</b><br>three</p><table border=1><tr><td>a &lt; b</td></tr></table><ul><li>i</li></ul></body></html>"
    assert documents.markdown_of(page) == "## Risk & more\n\nOne **two**\nthree\n\n<table><tr><td>a &lt; b</td></tr></table>\n\n- i"
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string")
    assert [r.markdown for r in documents.to_markdown(df, "h").collect()][1:] == [None, ""]


# files


def test_json_sources(spark, tmp_path):
    chunk = {"accession_number": "a", "ticker": "T", "company_name": "C", "filing_date": "2020-01-01", "form_type": "10-K", "chunks": [{"chunk_id": f"a_{i}", "chunk_index": i, "text": "x"} for i in range(3)]}
    (tmp_path / "chunks").mkdir()
    (tmp_path / "chunks/a.json").write_text(json.dumps(chunk, indent=1))
    rows = documents.read_chunk_files(spark, str(tmp_path / "chunks"))
    assert _rows(rows, "chunk_id", "ticker") == [(f"a_{i}", "T") for i in range(3)] and documents.read_chunk_files(spark, str(tmp_path / "chunks"), 2).count() == 2
    assert documents.keyword_documents(rows).columns[:2] == ["chunk_id", "content"]
    listing = {"cik": "12", "name": "N", "tickers": ["T", "U"], "filings": {"recent": {"accessionNumber": ["1", "2", "3"], "form": ["10-K", "10-Q", "10-K"], "filingDate": ["2020-01-02", "2020-05-01", "bad"], "isXBRL": [1, 0, 1]}}}
    (tmp_path / "l.json").write_text(json.dumps(listing))
    assert _rows(documents.read_listings(spark, str(tmp_path / "l.json"), forms=["10-K"]), "cik", "accession_number", "is_xbrl") == [("0000000012", "1", True)]
    assert _rows(documents.read_company_attributes(spark, str(tmp_path / "l.json")), "ticker", "sic_code") == [("T", "")]
    entity = {"accession_number": "a", "sections": [{"section_type": "item_1", "entities_by_type": {"ORG": [{"type": "ORG", "text": "X"}]}}]}
    (tmp_path / "e.json").write_text(json.dumps(entity))
    assert _rows(documents.read_entity_files(spark, str(tmp_path / "e.json"))) == [("a", "item_1", "ORG", "X")]
    index = spark.createDataFrame([('{"directory": {"item": [{"name": "a.htm", "type": "text", "size": "12", "last-modified": "d"}, {"name": "b", "size": ""}]}}',)], "j string")
    assert _rows(documents.directory_entries(index, "j"), "name", "size") == [("a.htm", 12), ("b", None)]
    files = spark.createDataFrame([("f/ex1.htm", 99), ("f/a.htm", 5), ("f/b.htm", 7), ("f/c.xml", 100)], "path string, length bigint")
    assert _rows(documents.primary_documents(files)) == [("f/b.htm", 7)]


INSTANCE = """<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:us-gaap="http://fasb.org/us-gaap/2020" xmlns:dei="http://xbrl.sec.gov/dei/2020" xmlns:own="http://own/1" xmlns:xbrldi="http://xbrl.org/2006/xbrldi">
<context id="i"><entity><segment><xbrldi:explicitMember dimension="us-gaap:Axis">own:M</xbrldi:explicitMember></segment></entity><period><instant>2020-12-31</instant></period></context>
<context id="d"><period><startDate>2020-01-01</startDate><endDate>2020-12-31</endDate></period></context>
<unit id="u"><measure>iso4217:USD</measure></unit><unit id="s"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>
<us-gaap:Assets contextRef="i" unitRef="u" decimals="-3">1,000</us-gaap:Assets><own:PerShare contextRef="d" unitRef="s" decimals="INF">2.5</own:PerShare>
<dei:DocumentPeriodEndDate contextRef="d">2020-12-31</dei:DocumentPeriodEndDate><us-gaap:Empty contextRef="d"> </us-gaap:Empty></xbrl>"""
LINKS = """<linkbase xmlns="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink">
<presentationLink xlink:role="http://x/role/BalanceSheet"><loc xlink:label="a" xlink:href="f.xsd#us-gaap_Assets"/><loc xlink:label="b" xlink:href="f.xsd#us-gaap_Cash"/><loc xlink:label="c" xlink:href="f.xsd#own_Loop"/>
<presentationArc xlink:from="a" xlink:to="b" order="2"/><presentationArc xlink:from="c" xlink:to="c" order="1"/></presentationLink>
<labelLink><loc xlink:label="a" xlink:href="f.xsd#us-gaap_Assets"/><label xlink:label="l1">All assets</label><label xlink:label="l2">Other</label><labelArc xlink:from="a" xlink:to="l1"/><labelArc xlink:from="a" xlink:to="l2"/></labelLink></linkbase>"""


def test_xbrl(spark, tmp_path):
    (tmp_path / "x-20201231.xml").write_text(INSTANCE)
    (tmp_path / "x-20201231_pre.xml").write_text(LINKS)
    (tmp_path / "broken.xml").write_text("<a><b>")
    files = xbrl.read_files(spark, str(tmp_path))
    one = xbrl.instances(files)
    assert [r.path.rpartition("/")[2] for r in one.collect()] == ["x-20201231.xml"]
    facts = xbrl.read_facts(one)
    got = {r.concept_name: r for r in facts.collect()}
    a, p = got["us-gaap:Assets"], got["own:PerShare"]
    assert (float(a.value), a.unit, a.decimals, a.period_type, a.period_end, a.dimensions, a.is_custom) == (1000.0, "USD", -3, "instant", datetime.date(2020, 12, 31), {"us-gaap:Axis": "own:M"}, False)
    assert (float(p.value), p.unit, p.decimals, p.period_type, p.period_start, p.is_custom) == (2.5, "USD/shares", None, "duration", datetime.date(2020, 1, 1), True)
    assert len(got) == 3 and got["dei:DocumentPeriodEndDate"].value_text == "2020-12-31"
    links = files.where("path like '%_pre.xml'")
    h = {r.concept_name: (r.parent_concept, r.depth, r.sort_order) for r in xbrl.read_hierarchy(links).collect()}
    assert h == {"us-gaap:Assets": (None, 0, 999.0), "us-gaap:Cash": ("us-gaap:Assets", 1, 2.0), "own:Loop": ("own:Loop", 0, 1.0)}
    assert _rows(xbrl.read_labels(links), "concept_name", "label") == [("us-gaap:Assets", "All assets")]
    full = {r.concept_name: (r.label, r.role) for r in xbrl.enriched(facts, xbrl.read_hierarchy(links), xbrl.read_labels(links)).collect()}
    assert full["us-gaap:Assets"] == ("All assets", "http://x/role/BalanceSheet") and full["own:PerShare"] == ("Per Share", None)
    assert [r.period_end for r in xbrl.document_period(facts).collect()] == [datetime.date(2020, 12, 31)]
    assert xbrl.read_facts(files.where("path like '%broken%'")).count() == 0


def test_role_sections(spark):
    roles = ["http://x/role/CONSOLIDATEDSTATEMENTSOFOPERATIONS", "http://x/role/StatementOfFinancialPositionClassified", "http://x/role/CASHFLOWS/", "http://x/role/DebtDetails", "http://x/role/_Odd_", "", None]
    df = spark.createDataFrame([(r,) for r in roles], "r string").select(xbrl.section_of(F.col("r")))
    assert [r[0] for r in df.collect()] == ["IncomeStatement", "BalanceSheet", "CashFlowStatement", "Debt", "Odd", "Other", "Other"]


# graphs


def test_components_and_statistics(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("x", "y"), ("x", "x")]
    edges = spark.createDataFrame(chain, "src string, dst string")
    nodes = spark.createDataFrame([(f"n{i:03d}",) for i in range(41)] + [("x",), ("y",), ("z",)], "id string")
    got = dict(_rows(graph.components(nodes, edges)))
    assert {got[f"n{i:03d}"] for i in range(41)} == {"n000"} and got["y"] == "x" and got["z"] == "z"
    assert _rows(graph.components(nodes, edges.limit(0))) == sorted((r.id, r.id) for r in nodes.collect())
    s = graph.statistics(nodes, edges).first()
    assert (s.nodes, s.max_degree, s.isolated, s.edges) == (44, 2, 1, 41)


def test_communities(spark):
    clique = lambda p: [(f"{p}{i}", f"{p}{j}", 1.0) for i in range(5) for j in range(i)]
    edges = spark.createDataFrame([*clique("a"), *clique("b"), ("a0", "b0", 0.1)], "src string, dst string, weight double")
    nodes = edges.selectExpr("src as id").union(edges.selectExpr("dst")).distinct()
    got = dict(_rows(graph.communities(nodes, edges)))
    assert len({got[f"a{i}"] for i in range(5)}) == 1 and len({got[f"b{i}"] for i in range(5)}) == 1 and got["a1"] != got["b1"]


def _propagated(edges, hashes):
    """Labels by the rounds of ``communities`` one node at a time, until none would move."""
    near = {}
    for a, b in {(a, b) for x, y in edges for a, b in ((x, y), (y, x)) if a != b}:
        near.setdefault(a, []).append(b)
    label = {x: x for x in hashes}

    def to(x):
        votes = {}
        for y in near.get(x, []):
            votes[label[y]] = votes.get(label[y], 0) + 1
        best = min(votes, key=lambda c: (-votes[c], c), default=None)
        return best if best is not None and votes[best] > votes.get(label[x], 0) else None

    for r in range(200):
        turns = 2 + r // 16
        moves = {x: to(x) for x in label if hashes[x] % turns == r % turns}
        label |= {x: c for x, c in moves.items() if c is not None}
        if all(to(x) is None for x in label):
            return label
    raise AssertionError("labels don't stand still")


def _sparse_graph(spark):
    """Edges in a loose large component and in small ones, pairs among them, which swap labels until their turns differ."""
    import random

    rng = random.Random(5)
    edges = [(f"l{rng.randrange(i)}", f"l{i}") for i in range(1, 60)] + [(f"l{rng.randrange(60)}", f"l{rng.randrange(60)}") for _ in range(15)]
    edges += [(f"p{i}", f"q{i}") for i in range(40)] + [(f"s{i}", f"s{i}{rng.randrange(9)}") for i in range(10) for _ in range(6)]
    nodes = spark.createDataFrame([(x,) for x in sorted({x for e in edges for x in e} | {"alone"})], "id string").repartition(3)
    return edges, nodes, spark.createDataFrame([(*e, 1.0) for e in edges], "src string, dst string, weight double")


def test_communities_stand_still(spark, smoke):
    from filigree.plans import passages as plans
    from filigree.plans.catalog import Tables

    # on these, rounds ended while four nodes would still move
    edges = plans.kg_edges_of(Tables(spark, smoke)).withColumn("weight", F.lit(1.0))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    hashes = {r.id: r.h for r in nodes.select("id", F.xxhash64("id").alias("h")).collect()}
    assert dict(_rows(graph.communities(nodes, edges))) == _propagated(_rows(edges, "src", "dst"), hashes)


def test_communities_in_tasks_and_by_rounds(spark):
    edges, nodes, table = _sparse_graph(spark)
    want = _propagated(edges, {r.id: r.h for r in nodes.select("id", F.xxhash64("id").alias("h")).collect()})
    assert dict(_rows(graph.communities(nodes, table))) == want
    # small components in several tasks, the large one by rounds over all tasks
    assert dict(_rows(graph.communities(nodes, table, most=100))) == want
    assert _rows(graph.communities(nodes, table.limit(0))) == [(x, x) for x in sorted(want)]
    with pytest.raises(RuntimeError, match="still change"):
        graph.communities(nodes, table, max_rounds=1)


def test_communities_need_no_job_for_each_round(spark):
    _, nodes, table = _sparse_graph(spark)
    spark.sparkContext.setJobGroup("communities", "")
    try:
        graph.communities(nodes, table).count()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("communities")) < 40
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_expand(spark):
    edges = spark.createDataFrame([("s", "a", 0.9), ("s", "b", 0.3), ("c", "s", 0.5), ("s", "v", 0.8)], "src string, dst string, weight double")
    near = graph.expand(spark.createDataFrame([("s",)], "id string"), edges, spark.createDataFrame([("s",), ("v",)], "id string"), per_seed=2)
    assert _rows(near) == [("a", 0.9, "s"), ("c", 0.5, "s")]


def test_passage_edges(spark):
    rows = [(f"{f}{s}{p}", f, "o" if f != "h" else "q", y, s, p) for f, y in (("f", 2018), ("g", 2020), ("h", 2021)) for s in "AB" for p in range(2)]
    nodes = spark.createDataFrame(rows, "id string, filing string, owner string, year int, section string, position int")
    assert passages.sequential(nodes).count() == 6 and passages.section_heads(nodes).count() == 3
    assert _rows(passages.temporal(nodes), "src", "dst") == [(f"f{s}{p}", f"g{s}{p}") for s in "AB" for p in range(2)]
    texts = spark.createDataFrame([("fA0", "about Quill Works here"), ("gA0", "QUILL WORKS"), ("hA0", "Quill Works"), ("gB0", "Quill only")], "id string, text string")
    said = passages.mentions(nodes, texts, spark.createDataFrame([("q", "Quill Works"), ("z", None)], "entity string, name string"))
    assert _rows(said) == [("fA0", "q"), ("gA0", "q")]
    assert _rows(passages.cooccurrence(nodes, said), "src", "dst") == [("fA0", "gA0")]
    both = passages.merged([passages.temporal(nodes), passages.cooccurrence(nodes, said)])
    assert both.where("src = 'fA0'").first().type == "temporal"
    links = spark.createDataFrame([("fA0", "gB1", 0.9), ("fA0", "gA0", 0.9), ("fA0", "nowhere", 1.0), ("fA0", "fA0", 1.0), ("fA1", "gB0", 0.5)], "id string, target string, score double")
    assert _rows(passages.similar(links, nodes, both), "src", "dst", "weight") == [("fA0", "gB1", 0.81)]


def test_close_names_against_all_pairs(spark):
    import random

    from filigree.functions import similarity

    def ratio(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return round(200 * row[-1] / (len(a) + len(b)) + 1e-9)

    rng = random.Random(3)
    names = {"mr daniel j. zelulmont", "daniel j. zelulmont", "zelmon", "zelumon", "xzelmon", "é" * 70, "é" * 69 + "a", "ab", "ba", "a" * 300, "a" * 310}
    for _ in range(60):
        base = "".join(rng.choice("abcde né") for _ in range(rng.randint(4, 30))).strip() + "x"
        names |= {base, base[1:], "q" + base, base[:3] + "zz" + base[3:], base[:2] + base[3:4] + base[2:3] + base[4:]}
    rows = [("PERSON", n) for n in names] + [("ORG", "daniel j. zelulmon"), ("ORG", None), (None, "ab")]
    got = _rows(similarity.close_names(spark.createDataFrame(rows, "type string, name string")), "type", "a", "b", "ratio")
    want = sorted(("PERSON", a, b, ratio(a, b)) for a in names for b in names if a < b and ratio(a, b) >= 90)
    assert sorted(got) == want and len(want) > 50
    assert ("PERSON", "zelmon", "zelumon", 92) in want and ("PERSON", "xzelmon", "zelmon", 92) in want


# search


def test_nearest_against_all_pairs(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    v = np.round(rng.normal(size=(90, 4)), 1)
    v[10:20] = v[9]  # ties go by id
    v[30] = 0
    rows = [(f"r{i:03}", x.tolist()) for i, x in enumerate(v)] + [("null", None), ("long", [1.0] * 5)]
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    unit = v.astype(np.float32).astype(float)
    norm = np.linalg.norm(unit, axis=1)
    monkeypatch.setattr(retrieval, "BLOCK_NUMBERS", 100)
    for k, least in ((7, None), (3, 0.6), (200, 0.9)):
        got = {}
        found = retrieval.nearest(df.select(F.col("id").alias("query"), F.col("embedding").alias("vector")), df, k, least)
        for r in found.orderBy("query", F.desc("score"), "id").collect():
            got.setdefault(r["query"], []).append(r["id"])
        assert got.pop("long") == ["long"]
        for i in range(90):
            if not norm[i]:
                assert f"r{i:03}" not in got
                continue
            score = np.round(unit @ unit[i] / np.where(norm > 0, norm, 1) / norm[i], 12)
            want = sorted((-s, f"r{j:03}") for j, s in enumerate(score) if norm[j] and (least is None or s >= least))[:k]
            assert got[f"r{i:03}"] == [x for _, x in want]


def test_similar_edges_cross_filings(spark):
    from filigree.plans import registry

    data = "/root/testdata/sf0.01"
    found = registry.queries()["pg_similar_all"](spark, data)
    filing = lambda c: F.split(c, "_")[0]
    assert found.where(filing("src") != filing("dst")).count() > 0 and found.where("weight < 0.54 - 1e-9").count() == 0


def test_vector_searches_for_every_query(spark):
    from filigree.plans import registry

    data = "/root/testdata/sf0.01"
    each, one = (registry.queries()[n](spark, data).collect() for n in ("vs_top_embeddings_each", "vs_top_embeddings"))
    ids = [r.vec_id for r in spark.read.parquet(f"{data}/embeddings.parquet").where("vec_id % 100 = 0").select("vec_id").collect()]
    assert len(ids) > 1 and len(each) == 20 * len(ids) and {r["query"] for r in each} == set(ids)
    assert sorted((r.id, r.score) for r in each if r["query"] == min(ids)) == sorted((r.vec_id, r.score) for r in one)


def test_keyword_search_for_every_query(spark):
    chunks = spark.createDataFrame([("a", "red fox red"), ("b", "red dog"), ("c", "blue cat")], "id string, text string")
    index = retrieval.postings(chunks)
    asked = {"q1": "RED dog red", "q2": "cat, blue", "q3": "absent"}
    got = retrieval.keyword_search_each(index, spark.createDataFrame(list(asked.items()), "query string, text string"), 5).collect()
    for q, words in asked.items():
        want = retrieval.keyword_search(index, words.replace(",", "").split(), 5).collect()
        assert sorted((r.id, round(r.score, 9)) for r in got if r["query"] == q) == sorted((r.id, round(r.score, 9)) for r in want)


def test_search(spark):
    rows = [("a", "red fox red", [1.0, 0.0]), ("b", "red dog", [0.9, 0.1]), ("c", "blue cat", [0.0, 1.0]), ("d", None, None), ("e", "", [0.0, 0.0])]
    chunks = spark.createDataFrame(rows, "id string, text string, embedding array<double>")
    probe = spark.createDataFrame([([1.0, 0.0],)], "vector array<double>")
    assert [r.id for r in retrieval.vector_search(chunks, probe, 2).collect()] == ["a", "b"] and retrieval.vector_search(chunks, probe, 9, least=0.5).count() == 2
    index = retrieval.postings(chunks)
    key = retrieval.keyword_search(index, ["RED", "nothing"], 5).collect()
    assert [r.id for r in key] == ["a", "b"] and key[0].score == 1.0
    assert retrieval.keyword_search(index, ["absent"], 5).count() == 0
    merged = {r.id: r for r in retrieval.hybrid(chunks, index, probe, "red", 3).collect()}
    assert merged["a"].sources == ["vector", "keyword"] and merged["c"].sources == ["vector"]
    assert retrieval.hybrid(chunks, index, probe, "blue cat", 3, retrieval.lexical_rerank(chunks, "blue cat")).first().id == "c"
    assert (retrieval.keyword_limit(3, 20), retrieval.keyword_limit(2, 20)) == (10, 5)


def test_routing(spark):
    q = spark.createDataFrame([(1, "Compare Alpha and Beta"), (2, "How does alpha compare"), (3, "Explain the reason"), (4, "What is it"), (5, "alphabet soup"), (6, None)], "id bigint, question string")
    aliases = spark.createDataFrame([("alpha", "A"), ("beta", "B")], "alias string, company string")
    got = {r.id: (r.kind, r.hops) for r in routing.route(routing.detect(q, aliases)).collect()}
    assert got == {1: ("cross_filing", 3), 2: ("cross_filing", 3), 3: ("complex", 2), 4: ("simple", 0), 5: ("complex", 2), 6: ("complex", 2)}
    assert routing.decompose(routing.route(routing.detect(q, aliases)), q).where("id = 1").count() == 2


def test_entities(spark):
    df = spark.createDataFrame([(1, "Net sales of $5.2 million in March 3, 2020 after a flood; 250 units and 12 dogs"), (2, None)], "id int, text string")
    assert _rows(entities.extract(df), "type", "text") == [("CARDINAL", "2020"), ("CARDINAL", "250"), ("DATE", "March 3, 2020"), ("METRIC", "net sales"), ("MONEY", "$5.2 million"), ("RISK", "flood")]
    assert entities.by_type(entities.extract(df)).first().total == 6
    r = spark.createDataFrame([(x,) for x in ("555-123-4567", "12345", "IV", "7", "1,200", "quarterly", "Q1 2021", "1899", "2020-01-01")], "t string").select("t", entities.is_count(F.col("t")), entities.is_date(F.col("t"))).collect()
    assert [x[1] for x in r[:5]] == [False, False, False, False, True] and [x[2] for x in r[5:]] == [False, True, False, True]


def test_quality_rules_on_fixtures(spark):
    d = datetime.date
    filings = spark.createDataFrame([("a", "10-K", d(2020, 5, 1), d(2020, 1, 1)), ("b", "10-K", d(2020, 4, 30), d(2020, 1, 1)), ("c", "10-Q", d(2020, 1, 1), d(2020, 2, 1)), ("d", "10-K", None, None)], "accession_number string, form_type string, filing_date date, period_of_report date")
    assert _rows(quality.filing_dates(filings), "accession_number", "severity") == [("a", "warning"), ("c", "error")]
    facts = [(1, "a", "A", 100.0), (2, "a", "L", 60.0), (3, "a", "E", 39.5), (4, "b", "A", 100.0), (5, "b", "L", 60.0), (6, "b", "E", 37.0), (7, "c", "A", 100.0), (8, "c", "L", 100.0), (9, "d", "A", 0.0), (10, "d", "E", 5.0), (11, "e", "A", 100.0), (12, "e", "L", 20.0)]
    df = spark.createDataFrame(facts, "id bigint, accession_number string, concept_name string, value double").withColumn("dimensions", F.lit(None).cast("map<string,string>")).withColumn("period_end", F.lit("2020-01-01").cast("date"))
    assert _rows(quality.balance(df, ["A"], ["L"], ["E"]), "accession_number", "severity") == [("b", "warning"), ("e", "error")]
    assert _rows(quality.required_concepts(filings, df, ["E"]), "accession_number") == [("c",)]
    v = {r.accession_number: r.valid for r in quality.verdict([quality.filing_dates(filings)], strict=True).collect()}
    assert v == {"a": False, "c": False}


# streams


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    df = spark.range(5).withColumn("ts", F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    df.write.parquet(source)
    for more in (0, 1, 0):
        if more:
            df.write.mode("append").parquet(source)
        ingest.drain(ingest.file_stream(spark, source, df.schema), out, mark)
    assert spark.read.parquet(out).count() == 10
    seen = []
    ingest.drain_into(ingest.file_stream(spark, source, df.schema, files_per_batch=1), str(tmp_path / "m2"), lambda batch, n: seen.append(batch.count()))
    assert sum(seen) == 10 and len(seen) > 1


def test_windows_of_a_stream_match_those_of_the_table(spark, tmp_path):
    rows = [(i, datetime.datetime(2024, 1, 1, i % 5, i % 60), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp, user int")
    df.write.parquet(str(tmp_path / "in"))
    stream = ingest.windowed(ingest.file_stream(spark, str(tmp_path / "in"), df.schema), "ts", ["user"], "1 hour")
    got = stream.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    got.awaitTermination()
    assert _rows(spark.table("hours")) == _rows(ingest.windowed(df, "ts", ["user"], "1 hour"))
    assert ingest.sessions(df, "ts", ["user"], "5 minutes").count() > 0


def test_empty_inputs_everywhere(spark, tmp_path):
    with pytest.raises(Exception):
        ingest.file_stream(spark, str(tmp_path / "none"), spark.range(1).schema)
    nodes = spark.createDataFrame([], "id string, filing string, owner string, year int, section string, position int")
    assert passages.merged([passages.sequential(nodes), passages.temporal(nodes)]).count() == 0
    assert upsert.duplicate_groups(nodes, ["id"]).count() == 0


def test_similarity_and_metrics(spark):
    from filigree.functions import similarity
    from filigree.operators import metrics

    r = spark.range(1).select(similarity.ratio(F.lit("abcdefghij"), F.lit("abcdefghix")), similarity.ratio(F.lit(""), F.lit(""))).first()
    assert tuple(r) == (90, 100)
    df = spark.createDataFrame([(["a", "b"],), (["b", "a"],), ([],), (None,)], "w array<string>").select(similarity.hashed_embedding(F.col("w"), 8).alias("v")).collect()
    assert df[0].v == df[1].v and abs(sum(x * x for x in df[0].v) - 1) < 1e-6 and df[2].v is None and df[3].v is None
    facts = spark.createDataFrame([("o", "A", 1.0, 2020, None, 1), ("o", "B", 2.0, 2020, None, 2), ("o", "A", None, 2021, None, 3), ("o", "B", 5.0, 2021, None, 4)], "owner string, concept_name string, value double, fiscal_year int, fiscal_quarter int, id bigint")
    maps = spark.createDataFrame([("m", "A", 1, 1.0), ("m", "B", 2, 0.5)], "metric_id string, concept_name string, priority int, confidence double")
    n = metrics.normalize(facts, maps)
    assert _rows(n, "fiscal_year", "metric_value") == [(2020, 1.0), (2021, 5.0)]
    assert metrics.lookup(n, year=0, owner="").count() == 2 and metrics.lookup(n, year=2021).count() == 1
    owners = spark.createDataFrame([("o",), ("p",)], "owner string")
    assert {r.owner: r.metric_value for r in metrics.compare(n, owners, "m").collect()} == {"o": 5.0, "p": None}
