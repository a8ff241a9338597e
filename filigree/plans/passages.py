"""The passage graph and the knowledge graph over the filing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.functions import text
from filigree.operators import graph, passages, retrieval
from filigree.plans.catalog import Catalog, Tables
from filigree.plans.relational import _FILINGS_SQL, filed, plain
from filigree.runtime import stage

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles

_CHUNKS_SQL = """chunk as (select * from chunks where chunk_id is not null qualify row_number() over (partition by chunk_id order by created_at desc nulls last, text) = 1)"""
_NODES_SQL = f"""{_FILINGS_SQL}, {_CHUNKS_SQL}, nodes as (
    select chunk_id as id, replace(chunk.accession_number, '-', '') as filing, cik as owner, cast(year(filing_date) as integer) as year, section_item as section, chunk_index as position
    from chunk left join filed on replace(chunk.accession_number, '-', '') = replace(filed.accession_number, '-', ''))"""
_SEQUENTIAL = "select least(id, nx) as src, greatest(id, nx) as dst, 'sequential' as type, 0.8::double as weight from (select id, lead(id) over (partition by filing, section order by position, id) as nx from nodes) where nx is not null"
_HEADS = "select a.id as src, b.id as dst, 'section_head' as type, 0.5::double as weight from heads a join heads b on a.filing = b.filing and a.id < b.id"
_HEADS_CTE = "heads as (select * from nodes qualify row_number() over (partition by filing, section order by position, id) = 1)"
_TEMPORAL_CTE = """placed as (select *, row_number() over (partition by owner, section, year order by filing, position, id) as place from nodes where owner is not null and year is not null),
    years as (select owner, section, year, lead(year) over (partition by owner, section order by year) as nx from (select distinct owner, section, year from placed))"""
_TEMPORAL = "select distinct least(a.id, b.id) as src, greatest(a.id, b.id) as dst, 'temporal' as type, 0.7::double as weight from placed a join years y using (owner, section, year) join placed b on b.owner = a.owner and b.section = a.section and b.year = y.nx and b.place = a.place where y.nx - y.year <= 2"


def chunks(t: Tables) -> DataFrame:
    """Chunks once each, as written last."""
    order = Window.partitionBy("chunk_id").orderBy(F.col("created_at").desc_nulls_last(), "text")
    return plain(t.chunks.where("chunk_id is not null").withColumn("n", F.row_number().over(order)).where("n = 1").drop("n"))


def nodes(t: Tables) -> DataFrame:
    dates = plain(filed(t)).select("accession_number", F.col("cik").alias("owner"), F.year("filing_date").alias("year"))
    rows = chunks(t).select("chunk_id", "accession_number", "section_item", "chunk_index").join(dates, "accession_number", "left")
    return rows.select(F.col("chunk_id").alias("id"), F.col("accession_number").alias("filing"), "owner", "year", F.col("section_item").alias("section"), F.col("chunk_index").alias("position"))


@query(f"with {_NODES_SQL} select n.*, substr(c.text, 1, 200) as preview from nodes n join chunk c on c.chunk_id = n.id")
def pg_nodes(t: Tables) -> DataFrame:
    return nodes(t).join(chunks(t).select(F.col("chunk_id").alias("id"), F.substring("text", 1, 200).alias("preview")), "id")


@query(f"with {_NODES_SQL} {_SEQUENTIAL}")
def pg_sequential(t: Tables) -> DataFrame:
    return passages.sequential(nodes(t))


@query(f"with {_NODES_SQL}, {_HEADS_CTE} {_HEADS}")
def pg_section_heads(t: Tables) -> DataFrame:
    return passages.section_heads(nodes(t))


@query(f"with {_NODES_SQL}, {_TEMPORAL_CTE} {_TEMPORAL}")
def pg_temporal(t: Tables) -> DataFrame:
    return passages.temporal(nodes(t))


_MENTIONS_CTE = """names as (select distinct lpad(cik, 10, '0') as entity, lower(company_name) as name from companies where company_name is not null and length(company_name) > 3),
    mentioned as (select distinct n.id, entity from nodes n join chunk c on c.chunk_id = n.id join names on contains(lower(c.text), name) where owner is null or owner <> entity)"""


def mentioned(t: Tables, of: DataFrame) -> DataFrame:
    names = t.companies.select(F.lpad("cik", 10, "0").alias("entity"), F.col("company_name").alias("name"))
    return passages.mentions(of, chunks(t).select(F.col("chunk_id").alias("id"), "text"), names)


@query(f"with {_NODES_SQL}, {_MENTIONS_CTE} select * from mentioned")
def pg_mentions(t: Tables) -> DataFrame:
    return mentioned(t, nodes(t))


_ENTITY_CTE = """firsts as (select m.entity, m.id, n.filing from mentioned m join nodes n using (id) qualify row_number() over (partition by entity, filing order by section, position, id) <= 5),
    turns as (select *, dense_rank() over (partition by entity order by filing) as turn from firsts)"""
_ENTITY = "select distinct least(a.id, b.id) as src, greatest(a.id, b.id) as dst, 'entity' as type, 0.6::double as weight from turns a join turns b on a.entity = b.entity and b.turn between a.turn + 1 and a.turn + 5"


@query(f"with {_NODES_SQL}, {_MENTIONS_CTE}, {_ENTITY_CTE} {_ENTITY}")
def pg_cooccurrence(t: Tables) -> DataFrame:
    n = nodes(t)
    return passages.cooccurrence(n, mentioned(t, n))


def local_edges(t: Tables) -> DataFrame:
    n = stage(nodes(t), label="passage-nodes")  # read by four builders
    return passages.merged([passages.sequential(n), passages.section_heads(n), passages.temporal(n), passages.cooccurrence(n, mentioned(t, n))])


_ALL_CTE = f"""{_NODES_SQL}, {_HEADS_CTE}, {_TEMPORAL_CTE}, {_MENTIONS_CTE}, {_ENTITY_CTE}, edges as (
    select * from ({_SEQUENTIAL} union all {_HEADS} union all {_TEMPORAL} union all {_ENTITY})
    qualify row_number() over (partition by src, dst order by case type when 'temporal' then 0 when 'entity' then 1 when 'sequential' then 2 else 3 end) = 1)"""


@query(f"with {_ALL_CTE} select src, dst, type, weight from edges")
def pg_edges(t: Tables) -> DataFrame:
    return local_edges(t)


@query(f"""with {_ALL_CTE}, d as (select id, count(e) as degree from nodes left join (select src as e from edges union all select dst from edges) on e = id group by 1)
    select count(*) as nodes, round(avg(degree), 6) as average_degree, max(degree) as max_degree, count(case when degree = 0 then 1 end) as isolated, (select count(*) from edges) as edges from d""")
def pg_statistics(t: Tables) -> DataFrame:
    return graph.statistics(nodes(t), stage(local_edges(t), label="passage-edges"))


@query(f"with {_ALL_CTE} select type, count(*) as n from edges group by 1")
def pg_edges_by_type(t: Tables) -> DataFrame:
    return local_edges(t).groupBy("type").agg(F.count("*").alias("n"))


@query(f"""with recursive {_NODES_SQL}, near as (select src, dst from ({_SEQUENTIAL}) union all select dst, src from ({_SEQUENTIAL})),
    reach as (select id, id as root from nodes union select r.id, n.dst from reach r join near n on n.src = r.root) select id, min(root) as component from reach group by 1""")
def pg_components(t: Tables) -> DataFrame:
    n = nodes(t)
    return graph.components(n, passages.sequential(n))


_LINKS_SQL = """links as (select a.chunk_id as id, b.chunk_id as target, list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) / sqrt(list_dot_product(b.embedding::double[], b.embedding::double[])) as score
    from chunk a join chunk b on replace(a.accession_number, '-', '') = replace(b.accession_number, '-', '') and a.chunk_id < b.chunk_id where list_dot_product(a.embedding::double[], a.embedding::double[]) > 0 and list_dot_product(b.embedding::double[], b.embedding::double[]) > 0)"""


@query(f"""with {_NODES_SQL}, {_LINKS_SQL}, fresh as (select id as src, target as dst, score * 0.9 as weight from links where score >= 0.1 and not exists (select 1 from ({_SEQUENTIAL}) s where s.src = id and s.dst = target)),
    ends as (select *, src as e from fresh union all select *, dst from fresh)
    select distinct src, dst, 'similar' as type, round(weight, 6) as weight from (select *, row_number() over (partition by e order by weight desc, src, dst) as n from ends) where n <= 10""")
def pg_similar(t: Tables) -> DataFrame:
    """Links by cosine within a filing, whose chunks are few."""
    n = nodes(t)
    v = chunks(t).where("embedding is not null").select("chunk_id", "accession_number", "embedding")
    pairs = v.join(v.select("accession_number", F.col("chunk_id").alias("target"), F.col("embedding").alias("other")), "accession_number").where("chunk_id < target")
    links = pairs.select(F.col("chunk_id").alias("id"), "target", text.cosine(F.col("embedding"), F.col("other")).alias("score"))
    return passages.similar(links, n, passages.sequential(n), least=0.1).withColumn("weight", F.round("weight", 6))


def similar_edges(t: Tables, existing: DataFrame) -> DataFrame:
    """Edges from each chunk to the five most similar of all others, whatever their filing, from cosine 0.60, where ``existing`` has none."""
    v = chunks(t).select("chunk_id", "embedding")
    # one more, as a chunk finds itself
    links = retrieval.nearest(v.select(F.col("chunk_id").alias("query"), F.col("embedding").alias("vector")), v.withColumnRenamed("chunk_id", "id"), 6, least=0.60)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    links = links.where("id <> query").withColumn("n", F.row_number().over(order)).where("n <= 5")
    return passages.similar(links.select(F.col("query").alias("id"), F.col("id").alias("target"), "score"), nodes(t), existing)


@query()
def pg_similar_all(t: Tables) -> DataFrame:
    """Similar edges over all filings; ``pg_similar`` is the smaller job its SQL names."""
    return similar_edges(t, local_edges(t))


@query()
def pg_edges_all(t: Tables) -> DataFrame:
    """The whole passage graph: the edges of ``pg_edges`` and the similar ones."""
    local = stage(local_edges(t), label="passage-edges")
    return local.unionByName(similar_edges(t, local))


# Knowledge graph


_KG_SQL = f"""{_FILINGS_SQL}, kg_nodes as (
        select 'company:' || cik as id, 'Company' as label, company_name as name from companies
        union all select distinct 'filing:' || replace(accession_number, '-', ''), 'Filing', null from filed
        union all select 'person:' || node_id, 'Person', name from person_nodes),
    kg_edges as (
        select 'company:' || cik as src, 'filing:' || replace(accession_number, '-', '') as dst, 'FILED' as rel_type from filed where cik in (select cik from companies)
        union select 'company:' || lpad(cik, 10, '0'), 'person:' || node_id, 'HAS_EXECUTIVE' from person_nodes where lpad(cik, 10, '0') in (select cik from companies)
        union select 'filing:' || replace(accession_number, '-', ''), 'mention:' || lower(trim(name)), 'MENTIONS_PERSON' from person_mentions where length(trim(name)) >= 2 and replace(accession_number, '-', '') in (select replace(accession_number, '-', '') from filed))"""


def kg_nodes_of(t: Tables) -> DataFrame:
    companies = t.companies.select(F.concat(F.lit("company:"), "cik").alias("id"), F.lit("Company").alias("label"), F.col("company_name").alias("name"))
    filings = plain(filed(t)).select(F.concat(F.lit("filing:"), "accession_number").alias("id"), F.lit("Filing").alias("label"), F.lit(None).cast("string").alias("name")).distinct()
    people = t.person_nodes.select(F.concat(F.lit("person:"), F.col("node_id").cast("string")).alias("id"), F.lit("Person").alias("label"), "name")
    return companies.unionByName(filings).unionByName(people)


def kg_edges_of(t: Tables) -> DataFrame:
    known = t.companies.select("cik")
    filings = plain(filed(t)).select("accession_number", "cik")
    made = filings.join(known, "cik", "left_semi").select(F.concat(F.lit("company:"), "cik").alias("src"), F.concat(F.lit("filing:"), "accession_number").alias("dst"), F.lit("FILED").alias("rel_type"))
    people = t.person_nodes.withColumn("cik", F.lpad("cik", 10, "0")).join(known, "cik", "left_semi")
    people = people.select(F.concat(F.lit("company:"), "cik").alias("src"), F.concat(F.lit("person:"), F.col("node_id").cast("string")).alias("dst"), F.lit("HAS_EXECUTIVE").alias("rel_type"))
    said = plain(t.person_mentions).where(F.length(F.trim("name")) >= 2).join(filings.select("accession_number"), "accession_number", "left_semi")
    said = said.select(F.concat(F.lit("filing:"), "accession_number").alias("src"), F.concat(F.lit("mention:"), F.lower(F.trim("name"))).alias("dst"), F.lit("MENTIONS_PERSON").alias("rel_type"))
    return made.unionByName(people).unionByName(said).distinct()


@query(f"with {_KG_SQL} select label, count(*) as n from kg_nodes group by 1")
def kg_nodes_by_label(t: Tables) -> DataFrame:
    return kg_nodes_of(t).groupBy("label").agg(F.count("*").alias("n"))


@query(f"with {_KG_SQL} select rel_type, count(*) as n from kg_edges group by 1")
def kg_edges_by_type(t: Tables) -> DataFrame:
    return kg_edges_of(t).groupBy("rel_type").agg(F.count("*").alias("n"))


@query(f"""with {_KG_SQL} select c.name as company, count(distinct f.dst) as filings, count(distinct m.dst) as people from kg_nodes c join kg_edges f on f.src = c.id and f.rel_type = 'FILED' join kg_edges m on m.src = f.dst and m.rel_type = 'MENTIONS_PERSON'
    where c.label = 'Company' group by c.id, c.name""")
def kg_path_company_filing_person(t: Tables) -> DataFrame:
    n, e = kg_nodes_of(t).where("label = 'Company'"), kg_edges_of(t)
    f = e.where("rel_type = 'FILED'").select(F.col("src").alias("id"), F.col("dst").alias("filing"))
    m = e.where("rel_type = 'MENTIONS_PERSON'").select(F.col("src").alias("filing"), F.col("dst").alias("person"))
    rows = n.join(f, "id").join(m, "filing")
    return rows.groupBy("id", "name").agg(F.countDistinct("filing").alias("filings"), F.countDistinct("person").alias("people")).select(F.col("name").alias("company"), "filings", "people")


@query()
def kg_communities(t: Tables) -> DataFrame:
    """(community, members, companies): communities of the knowledge graph by propagation of labels."""
    edges = stage(kg_edges_of(t), label="kg-edges")  # read for its nodes and for its sides
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = graph.communities(ids, edges.withColumn("weight", F.lit(1.0)))
    return found.groupBy("community").agg(F.count("*").alias("members"), F.count_if(F.col("id").startswith("company:")).alias("companies"))
