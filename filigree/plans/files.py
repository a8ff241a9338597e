"""Queries over file sources and sinks: the tables are written in the form of the source, and read back by its reader."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.plans.catalog import Catalog, Tables
from filigree.runtime import plain_accession, shared_dir
from filigree.sources import documents, sinks, xbrl

_catalog = Catalog()
query, QUERIES, ORACLES = _catalog.query, _catalog.queries, _catalog.oracles


def _folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/filigree-{t.spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def _as_files(t: Tables, rows: DataFrame, name: str) -> str:
    """Writes the texts (folder, text), one to a file, and gives the folder of all."""
    path = _folder(t, name)
    rows.repartition("folder").write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
    return path


_FACTS = "regexp_like(concept_name, '^us-gaap:[A-Za-z]+$') and value is not null and period_end is not null and accession_number is not null"


@query(f"""
    select replace(trim(accession_number), '-', '') as accession_number, concept_name, period_end, count(*) as facts, sum(value) as total
    from facts where {_FACTS.replace("regexp_like", "regexp_matches")} group by all""")
def src_xbrl_facts(t: Tables) -> DataFrame:
    """(accession_number, concept_name, period_end, facts, total): numeric facts as XBRL instances, parsed again."""
    rows = t.facts.where(_FACTS).select(plain_accession(F.col("accession_number")).alias("folder"), "id", "concept_name", "value", "period_start", "period_end")
    start = F.when(F.col("period_start").isNotNull(), F.format_string("<startDate>%s</startDate><endDate>%s</endDate>", F.col("period_start").cast("string"), F.col("period_end").cast("string"))).otherwise(F.format_string("<instant>%s</instant>", F.col("period_end").cast("string")))
    one = F.concat(F.format_string('<context id="c%s"><period>', "id"), start, F.format_string('</period></context><%s contextRef="c%s" decimals="0">%s</%s>', "concept_name", "id", F.col("value").cast("string"), "concept_name"))
    # a filing's facts are one document
    body = rows.groupBy("folder").agg(F.array_join(F.collect_list(one), "").alias("body"))
    head = '<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:us-gaap="http://fasb.org/us-gaap/2023">'
    path = _as_files(t, body.select("folder", F.concat(F.lit(head), "body", F.lit("</xbrl>")).alias("text")), "instances")
    facts = xbrl.read_facts(xbrl.read_files(t.spark, path, "*.txt"))
    name = F.regexp_extract("path", r"folder=([^/]+)/", 1)
    return facts.groupBy(name.alias("accession_number"), "concept_name", "period_end").agg(F.count("*").alias("facts"), F.sum("value").alias("total"))


@query("""
    select chunk_id, replace(accession_number, '-', '') as accession_number, section_item, chunk_index, token_count, contains_table, length(text) as size, count(*) as n
    from chunks where accession_number is not null group by all""")
def src_chunk_files(t: Tables) -> DataFrame:
    """(chunk_id, accession_number, section_item, chunk_index, token_count, contains_table, size, n): chunks as one JSON file a filing, read again."""
    fields = ["chunk_id", "accession_number", "section_item", "section_title", "chunk_index", "context_prefix", "text", "token_count", "contains_table"]
    rows = t.chunks.where("accession_number is not null").withColumn("accession_number", F.regexp_replace("accession_number", "-", ""))
    files = rows.groupBy(F.col("accession_number").alias("folder")).agg(F.collect_list(F.struct(*fields)).alias("chunks"))
    files = files.select("folder", F.to_json(F.struct(F.col("folder").alias("accession_number"), F.size("chunks").alias("total_chunks"), "chunks")).alias("text"))
    got = documents.read_chunk_files(t.spark, _as_files(t, files, "chunk-files"))
    return got.groupBy("chunk_id", "accession_number", "section_item", "chunk_index", "token_count", "contains_table", F.length("text").cast("bigint").alias("size")).agg(F.count("*").alias("n"))


@query("""
    select replace(accession_number, '-', '') as accession_number, section_type, 'PERSON' as type, name as text, count(*) as n
    from person_mentions where accession_number is not null and section_type is not null and name is not null group by all""")
def src_entity_files(t: Tables) -> DataFrame:
    """(accession_number, section_type, type, text, n): mentions as one JSON file of entities a filing, read again."""
    rows = t.person_mentions.where("accession_number is not null and section_type is not null and name is not null").withColumn("accession_number", F.regexp_replace("accession_number", "-", ""))
    sections = rows.groupBy("accession_number", "section_type").agg(F.collect_list(F.struct(F.lit("PERSON").alias("type"), F.col("name").alias("text"))).alias("e"))
    section = F.struct("section_type", F.size("e").alias("total_entities"), F.create_map(F.lit("PERSON"), F.col("e")).alias("entities_by_type"))
    files = sections.groupBy(F.col("accession_number").alias("folder")).agg(F.collect_list(section).alias("sections"))
    files = files.select("folder", F.to_json(F.struct(F.col("folder").alias("accession_number"), "sections")).alias("text"))
    got = documents.read_entity_files(t.spark, _as_files(t, files, "entity-files"))
    return got.groupBy("accession_number", "section_type", "type", "text").agg(F.count("*").alias("n"))


_LISTED = "regexp_like(cik, '^[0-9]{1,10}$') and filing_date is not null"


@query(f"""
    select lpad(cik, 10, '0') as cik, accession_number, form_type, filing_date, period_of_report, primary_document, is_xbrl, count(*) as n
    from filings where {_LISTED.replace("regexp_like", "regexp_matches")} group by all""")
def src_listings(t: Tables) -> DataFrame:
    """(cik, accession_number, form_type, filing_date, period_of_report, primary_document, is_xbrl, n): filings as a company's listing of parallel arrays, read again."""
    rows = t.filings.where(_LISTED).withColumn("cik", F.lpad("cik", 10, "0"))
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    one = F.struct(
        F.col("accession_number").alias("accessionNumber"), F.col("form_type").alias("form"), day("filing_date").alias("filingDate"), day("period_of_report").alias("reportDate"), F.col("primary_document").alias("primaryDocument"), F.col("is_xbrl").cast("int").alias("isXBRL")
    )
    files = rows.groupBy(F.col("cik").alias("folder")).agg(F.collect_list(one).alias("f"))
    names = ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument", "isXBRL"]
    recent = F.struct(*[F.col(f"f.{n}").alias(n) for n in names]).alias("recent")
    files = files.select("folder", F.to_json(F.struct(F.col("folder").alias("cik"), F.struct(recent).alias("filings")), {"ignoreNullFields": "false"}).alias("text"))
    got = documents.read_listings(t.spark, _as_files(t, files, "listings"))
    return got.groupBy("cik", "accession_number", "form_type", "filing_date", "period_of_report", "primary_document", "is_xbrl").agg(F.count("*").alias("n"))


@query("""
    select vec_id as id, (vec_id % 2 = 0) as renewed, round(list_sum(embedding::double[]), 4) as total from embeddings""")
def snk_vector_collection(t: Tables) -> DataFrame:
    """(id, renewed, total): a collection of vectors filled, then half of it replaced."""
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    path = _folder(t, "collection")
    dim = rows.select(F.size("embedding").alias("n")).first()
    dim = dim["n"] if dim else 1
    sinks.upsert_vectors(rows.withColumn("renewed", F.lit(False)), path, dim)
    sinks.upsert_vectors(rows.where("id % 2 = 0").withColumn("renewed", F.lit(True)), path, dim)
    total = F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return t.spark.read.parquet(path).select("id", "renewed", F.round(total, 4).alias("total"))


@query("""
    select accession_number, count(*) as n from (select distinct replace(accession_number, '-', '') as accession_number, item from filing_sections where accession_number is not null and item is not null) group by 1""")
def snk_write_new(t: Tables) -> DataFrame:
    """(accession_number, n): sections written twice into a table that takes only new keys."""
    rows = t.filing_sections.where("accession_number is not null and item is not null").select(F.regexp_replace("accession_number", "-", "").alias("accession_number"), "item").distinct()
    path = _folder(t, "sections")
    sinks.write_new(rows.where("item = '7'"), path, ["accession_number", "item"])
    for _ in range(2):
        sinks.write_new(rows, path, ["accession_number", "item"])
    return t.spark.read.parquet(path).groupBy("accession_number").agg(F.count("*").alias("n"))
