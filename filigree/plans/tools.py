"""Metrics, look-ups, graph answers and operational summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.functions import similarity
from filigree.operators import metrics
from filigree.operators.retrieval import terms
from filigree.plans.catalog import Catalog, Tables
from filigree.plans.passages import _CHUNKS_SQL, chunks
from filigree.plans.relational import _FILINGS_SQL, filed, plain

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles

#: Metric, concept, priority, confidence.
MAPPINGS = [
    ("revenue", "us-gaap:Revenues", 1, 1.0), ("revenue", "us-gaap:GrossMargin", 2, 0.5), ("net_income", "us-gaap:NetResult", 1, 1.0), ("net_income", "us-gaap:OperatingResult", 2, 0.6),
    ("assets", "us-gaap:Assets", 1, 1.0), ("cash", "us-gaap:CashOnHand", 1, 0.9),
]
_MAPPINGS_SQL = "m as (select * from (values " + ", ".join(map(str, MAPPINGS)) + ") v(metric_id, concept_name, priority, confidence))"
_NORMAL_SQL = f"""{_FILINGS_SQL}, {_MAPPINGS_SQL}, normal as (
    select cik as owner, cast(year(period_end) as integer) as fiscal_year, cast(null as integer) as fiscal_quarter, metric_id, cast(value as double) as metric_value, f.concept_name as source_concept, confidence::double as confidence
    from facts f join m using (concept_name) join filed on replace(f.accession_number, '-', '') = replace(filed.accession_number, '-', '')
    where value is not null and period_end is not null and coalesce(cardinality(dimensions), 0) = 0
    qualify row_number() over (partition by cik, year(period_end), metric_id order by priority, confidence desc, f.id desc) = 1)"""


def normalized(t: Tables) -> DataFrame:
    owners = plain(filed(t)).select("accession_number", F.col("cik").alias("owner"))
    facts = plain(t.facts).where((F.coalesce(F.size("dimensions"), F.lit(0)) <= 0) & F.col("period_end").isNotNull() & F.col("concept_name").isin(sorted({c for _, c, _, _ in MAPPINGS})))
    facts = facts.join(owners, "accession_number").select("owner", "concept_name", F.col("value").cast("double").alias("value"), F.year("period_end").alias("fiscal_year"), F.lit(None).cast("int").alias("fiscal_quarter"), "id")
    return metrics.normalize(facts, t.spark.createDataFrame(MAPPINGS, "metric_id string, concept_name string, priority int, confidence double"))


@query(f"with {_NORMAL_SQL} select * from normal")
def mt_normalized(t: Tables) -> DataFrame:
    return normalized(t)


@query(f"with {_NORMAL_SQL} select * from normal where metric_id = 'revenue' and fiscal_year = 2018")
def mt_lookup(t: Tables) -> DataFrame:
    return metrics.lookup(normalized(t), year=2018, metric="revenue")


@query(f"with {_NORMAL_SQL} select lpad(c.cik, 10, '0') as owner, fiscal_year, metric_value from companies c left join (select * from normal where metric_id = 'assets' qualify row_number() over (partition by owner order by fiscal_year desc) = 1) n on n.owner = lpad(c.cik, 10, '0')")
def mt_compare(t: Tables) -> DataFrame:
    return metrics.compare(normalized(t), t.companies.select(F.lpad("cik", 10, "0").alias("owner")), "assets")


@query(f"with {_NORMAL_SQL} select c.ticker, c.company_name, n.metric_id, n.fiscal_year, n.metric_value from normal n join companies c on c.cik = n.owner where c.ticker is not null")
def mt_with_names(t: Tables) -> DataFrame:
    names = t.companies.where("ticker is not null").select(F.col("cik").alias("owner"), "ticker", "company_name")
    return normalized(t).join(names, "owner").select("ticker", "company_name", "metric_id", "fiscal_year", "metric_value")


@query(f"with {_NORMAL_SQL} select owner, metric_id, fiscal_year, round(metric_value - lag(metric_value) over (partition by owner, metric_id order by fiscal_year), 4) as change from normal")
def mt_change_by_year(t: Tables) -> DataFrame:
    order = Window.partitionBy("owner", "metric_id").orderBy("fiscal_year")
    return normalized(t).select("owner", "metric_id", "fiscal_year", F.round(F.col("metric_value") - F.lag("metric_value").over(order), 4).alias("change"))


@query("""select replace(accession_number, '-', '') as acc, cast(max(case when concept_name like '%Revenue%' then value end) as double) as revenue, cast(max(case when concept_name = 'us-gaap:Assets' then value end) as double) as assets from facts group by 1""")
def mt_metrics_of_filing(t: Tables) -> DataFrame:
    """As the per-company look-up has it: any concept that names revenue, whatever its period or dimensions."""
    value = lambda rule: F.max(F.when(rule, F.col("value"))).cast("double")
    return plain(t.facts).groupBy(F.col("accession_number").alias("acc")).agg(value(F.col("concept_name").like("%Revenue%")).alias("revenue"), value(F.col("concept_name") == "us-gaap:Assets").alias("assets"))


# Answers from the graph


@query(f"""with {_FILINGS_SQL}, p as (select lpad(cik, 10, '0') as cik, string_agg(distinct trim(name) || coalesce(' (' || role || ')', ''), '; ' order by trim(name) || coalesce(' (' || role || ')', '')) as people from person_nodes where trim(name) <> '' group by 1),
    f as (select cik, accession_number, filing_date from filed where filing_date is not null qualify row_number() over (partition by cik order by filing_date desc, accession_number) <= 3)
    select c.cik, 'executives' as kind, people as content, 0.5::double as score from companies c join p using (cik) union all select cik, 'filing', accession_number, 0.7::double from f where cik in (select cik from companies)""")
def gs_company(t: Tables) -> DataFrame:
    """Executives of each company in one row and its three latest filings, with the scores of their kinds."""
    known = t.companies.select("cik")
    label = F.concat(F.trim("name"), F.coalesce(F.concat(F.lit(" ("), "role", F.lit(")")), F.lit("")))
    people = t.person_nodes.where("trim(name) <> ''").select(F.lpad("cik", 10, "0").alias("cik"), label.alias("who")).distinct()
    people = people.groupBy("cik").agg(F.array_join(F.sort_array(F.collect_list("who")), "; ").alias("content"))
    last = filed(t).where("filing_date is not null").withColumn("n", F.row_number().over(Window.partitionBy("cik").orderBy(F.desc("filing_date"), "accession_number"))).where("n <= 3")
    a = people.join(known, "cik", "left_semi").select("cik", F.lit("executives").alias("kind"), "content", F.lit(0.5).alias("score"))
    b = last.join(known, "cik", "left_semi").select("cik", F.lit("filing").alias("kind"), F.col("accession_number").alias("content"), F.lit(0.7).alias("score"))
    return a.unionByName(b)


@query("select n.node_id, c.company_name, 0.8::double as score from person_nodes n join companies c on lpad(n.cik, 10, '0') = c.cik where contains(n.name, 'Olga')")
def gs_person(t: Tables) -> DataFrame:
    names = t.companies.select("cik", "company_name")
    return t.person_nodes.where(F.col("name").contains("Olga")).withColumn("cik", F.lpad("cik", 10, "0")).join(names, "cik").select("node_id", "company_name", F.lit(0.8).alias("score"))


@query("""with p as (select distinct lpad(cik, 10, '0') as cik, lower(trim(name)) as name from person_nodes where length(trim(name)) >= 4),
    s as (select a.cik, a.name as a, b.name as b, round((1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))) * 100) as r from p a join p b on a.cik = b.cik and left(a.name, 1) = left(b.name, 1) and a.name < b.name and abs(length(a.name) - length(b.name)) <= 4)
    select cik, a, b, cast(r as integer) as ratio from s where r >= 90""")
def kg_fuzzy_names(t: Tables) -> DataFrame:
    """Names of one company that agree by 90 percent, blocked by company and first letter."""
    p = t.person_nodes.select(F.lpad("cik", 10, "0").alias("cik"), F.lower(F.trim("name")).alias("a")).where("length(a) >= 4").distinct().withColumn("first", F.left("a", F.lit(1)))
    pairs = p.join(p.withColumnRenamed("a", "b"), ["cik", "first"]).where("a < b and abs(length(a) - length(b)) <= 4")
    return pairs.select("cik", "a", "b", similarity.ratio(F.col("a"), F.col("b")).alias("ratio")).where("ratio >= 90")


@query()
def kg_similar_names(t: Tables) -> DataFrame:
    """(type, a, b, ratio): all names of people (nodes, their other spellings, mentions) and of companies that agree by 90 percent within their type, whatever the company; ``kg_fuzzy_names`` is the smaller job its SQL names."""
    nodes = t.person_nodes.select(F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    people = nodes.unionByName(t.person_mentions.select("name")).select(F.lit("PERSON").alias("type"), "name")
    names = people.unionByName(t.companies.select(F.lit("ORG").alias("type"), F.col("company_name").alias("name")))
    return similarity.close_names(names.select("type", F.lower(F.trim("name")).alias("name")).where("length(name) >= 2"))


@query()
def kg_community_summaries(t: Tables) -> DataFrame:
    """(cik, members, summary): the group around each company with a summary made by rule: how many of what, and the first names."""
    people = t.person_nodes.select(F.lpad("cik", 10, "0").alias("cik"), F.lit("Person").alias("label"), "name")
    filings = filed(t).select("cik", F.lit("Filing").alias("label"), F.col("accession_number").alias("name"))
    members = people.unionByName(filings)
    kinds = members.groupBy("cik", "label").agg(F.count("*").alias("n"))
    kinds = kinds.groupBy("cik").agg(F.sum("n").alias("members"), F.sort_array(F.collect_list(F.struct("label", "n"))).alias("k"))
    sample = people.withColumn("n", F.row_number().over(Window.partitionBy("cik").orderBy("name"))).where("n <= 6").groupBy("cik").agg(F.sort_array(F.collect_list("name")).alias("first"))
    text = F.concat_ws("; ", F.array_join(F.transform("k", lambda x: F.concat(x["n"].cast("string"), F.lit(" "), x["label"])), ", "), F.array_join("first", ", "))
    return kinds.where("members >= 5").join(sample, "cik", "left").select("cik", "members", F.substring(text, 1, 1000).alias("summary"))


@query()
def vs_hashed_embeddings(t: Tables) -> DataFrame:
    """(id, vector): vectors of chunks without a model, for tests and where none is at hand."""
    rows = chunks(t).where("text is not null").select(F.col("chunk_id").alias("id"), terms(F.col("text")).alias("words"))
    return rows.select("id", similarity.hashed_embedding(F.col("words")).alias("vector"))


# Operations


@query("""select event_type as stage, count(*) as runs, count(case when value < 10 then 1 end) as failed, min(ts) as first_run, max(ts) as last_run, round(count(case when value < 10 then 1 end) / count(*)::double, 6) as failure_rate from events group by 1""")
def op_pipeline_summary(t: Tables) -> DataFrame:
    failed = F.count_if(F.col("value") < 10)
    return t.events.groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("runs"), failed.alias("failed"), F.min("ts").alias("first_run"), F.max("ts").alias("last_run"), F.round(failed / F.count("*"), 6).alias("failure_rate"))


@query(f"with {_CHUNKS_SQL} select cast(sum(length(text)) as bigint) as characters, cast(sum(token_count) as bigint) as tokens, round(count(*) * 450 / 1e6 * 0.14 + count(*) * 80 / 1e6 * 0.28, 2) as question_cost from chunk")
def op_cost_estimate(t: Tables) -> DataFrame:
    n = F.count("*")
    return chunks(t).agg(F.sum(F.length("text")).alias("characters"), F.sum("token_count").alias("tokens"), F.round(n * 450 / 1e6 * 0.14 + n * 80 / 1e6 * 0.28, 2).alias("question_cost"))


@query("""select t as table_name, n from (select 'companies' as t, count(*) as n from companies union all select 'filings', count(*) from filings union all select 'facts', count(*) from facts union all select 'filing_sections', count(*) from filing_sections union all select 'chunks', count(*) from chunks)""")
def op_row_counts(t: Tables) -> DataFrame:
    parts = [getattr(t, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n in ("companies", "filings", "facts", "filing_sections", "chunks")]
    return reduce(DataFrame.unionByName, parts)
