"""Queries of this subpackage over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.llm import canonical, contamination, names, neardup, neighbors, packing, splitting, sql
from filigree.runtime import padded_cik, plain_accession, shared_dir, stage, table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbors.neighbours(table(spark, sf_dir, "chunks"), "chunk_id", "embedding", k=5)
    return near.select(F.least("key", "other").alias("chunk_a"), F.greatest("key", "other").alias("chunk_b")).distinct()


def _near_copies(spark: SparkSession, sf_dir: str) -> neardup.NearDuplicates:
    texts = _texts(spark, sf_dir).where("item_key is not null")
    return neardup.near_duplicates(texts, ["kind", "item_key"], "text", within=["kind"], threshold=0.6, width=3, min_words=30)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _near_copies(spark, sf_dir).pairs().where("id_a.kind = id_b.kind")
    return pairs.select(F.col("id_a.kind").alias("kind"), F.col("id_a.item_key").alias("key_a"), F.col("id_b.item_key").alias("key_b"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_copies(spark, sf_dir).classes()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id", "passage")
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = canonical.lookalike_pairs(table(spark, sf_dir, "documents"), "doc_id", "text", min_chars=30)
    return pairs.select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))


def _name_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, company, names, date) of mentions and nodes."""
    filings = table(spark, sf_dir, "filings").select(plain_accession(F.col("accession_number")).alias("filing"), padded_cik(F.col("cik")).alias("company")).dropna().distinct()
    mentions = table(spark, sf_dir, "person_mentions").select(F.col("mention_id").alias("id"), plain_accession(F.col("accession_number")).alias("filing"), F.array("name").alias("names"), F.col("start_date").alias("date"))
    nodes = table(spark, sf_dir, "person_nodes").select(
        F.col("node_id").alias("id"), padded_cik(F.col("cik")).alias("company"), F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"), F.date_format("tenure_start", "yyyy-MM-dd").alias("date")
    )
    return mentions.join(filings, "filing").select("id", "company", "names", "date").unionByName(nodes.select("id", "company", "names", "date"))


def p1_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.resolve(_name_records(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked_pairs(p1_entities(spark, sf_dir))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, item_key, text): sections by id and chunks by chunk_id."""
    sections = table(spark, sf_dir, "filing_sections").select(F.lit("section").alias("kind"), F.col("id").cast("string").alias("item_key"), F.col("markdown").alias("text"))
    chunks = table(spark, sf_dir, "chunks").select(F.lit("chunk").alias("kind"), F.col("chunk_id").alias("item_key"), "text")
    return sections.unionByName(chunks)


def _chunk_configs(spark: SparkSession, sf_dir: str) -> list[splitting.Config]:
    rows = table(spark, sf_dir, "chunk_configs").orderBy("config_name").collect()  # a fixed table of three rows
    return [splitting.Config(r.config_name, r.max_tokens, r.overlap_tokens, r.min_tokens, r.tokens_per_word) for r in rows]


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split(_texts(spark, sf_dir), ["kind", "item_key"], "text", _chunk_configs(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = splitting.split(_texts(spark, sf_dir), ["kind", "item_key"], "text", _chunk_configs(spark, sf_dir), with_text=False)
    return pieces.where("piece = 0 and item_key is not null").select("kind", "item_key", "config_name").distinct()


def p3_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each text over a limit: the words in its pieces, the pieces over the limit, the words left out or out of order between pieces, and the longest overlap."""
    configs = _chunk_configs(spark, sf_dir)
    texts = _texts(spark, sf_dir).where("item_key is not null").distinct().withColumn("digest", F.md5("text"))
    pieces = splitting.split(texts, ["kind", "item_key", "digest"], "text", configs, with_text=False)
    room = F.create_map(*[x for c in configs for x in (F.lit(c.name), F.lit(c.limits()[0]))])
    words = F.col("end_word") - F.col("start_word")
    of = Window.partitionBy("kind", "item_key", "digest", "config_name").orderBy("piece")
    pieces = pieces.withColumn("before", F.coalesce(F.lag("end_word").over(of), F.lit(0)))
    return pieces.groupBy("kind", "item_key", "digest", "config_name").agg(
        F.sum(words - F.col("overlap_words")).alias("words"), F.count_if(words > room[F.col("config_name")]).alias("over"),
        F.count_if(F.col("start_word") + F.col("overlap_words") != F.col("before")).alias("torn"), F.max("overlap_words").alias("overlap"),
    )


def p3_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sections as a few large files, split in byte ranges: the words in the pieces of each configuration, pieces over the limit, words between pieces."""
    configs = _chunk_configs(spark, sf_dir)
    folder = f"{shared_dir(spark)}/filigree-{spark.sparkContext.applicationId}/files-{uuid4().hex}"
    table(spark, sf_dir, "filing_sections").where("markdown is not null").select("markdown").repartition(3).write.text(folder)
    pieces = splitting.split_files(spark, f"{folder}/*.txt", configs, with_text=False, range_bytes=1 << 16)
    room = F.create_map(*[x for c in configs for x in (F.lit(c.name), F.lit(c.limits()[0]))])
    words = F.col("end_word") - F.col("start_word")
    pieces = pieces.withColumn("before", F.coalesce(F.lag("end_word").over(Window.partitionBy("path", "config_name").orderBy("piece")), F.lit(0)))
    return pieces.groupBy("config_name").agg(
        F.sum(words - F.col("overlap_words")).alias("words"), F.count_if(words > room[F.col("config_name")]).alias("over"), F.count_if(F.col("start_word") + F.col("overlap_words") != F.col("before")).alias("torn")
    )


def _pack_specs(spark: SparkSession, sf_dir: str) -> list[packing.Spec]:
    rows = table(spark, sf_dir, "pack_specs").orderBy("capacity_tokens", "spec_name").collect()  # a fixed table of three rows
    return [packing.Spec(r.spec_name, r.capacity_tokens, r.separator_tokens or 0) for r in rows]


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", _pack_specs(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def p6_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each spec: the texts packed, containers over capacity or with overlapping texts, texts cut that need not be, and texts whose pieces do not follow each other."""
    specs = _pack_specs(spark, sf_dir)
    packed = stage(packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", specs), label="packed")
    room = F.create_map(*[x for s in specs for x in (F.lit(s.name), F.lit(s.capacity))])[F.col("spec_name")]
    apart = F.create_map(*[x for s in specs for x in (F.lit(s.name), F.lit(s.separator))])[F.col("spec_name")]
    end = F.lag(F.col("token_offset") + F.col("n_tokens") + apart).over(Window.partitionBy("spec_name", "container_id").orderBy("slot"))
    boxes = packed.where("container_id is not null").withColumn("bad", (F.col("token_offset") + F.col("n_tokens") > room) | (F.col("token_offset") != F.coalesce(end, F.lit(0))))
    boxes = boxes.groupBy("spec_name").agg(F.count_distinct(F.when(F.col("bad"), F.col("container_id"))).alias("over"))
    texts = packed.groupBy("spec_name", "key").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"), F.max(F.col("token_start") + F.col("n_tokens")).alias("last"), F.count_distinct("piece_no").alias("numbers"))
    texts = texts.groupBy("spec_name").agg(F.count("*").alias("texts"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= room)).alias("cut"), F.count_if((F.col("last") != F.col("tokens")) | (F.col("numbers") != F.col("pieces"))).alias("torn"))
    return texts.join(boxes, "spec_name").select("spec_name", "texts", "over", "cut", "torn")


QUERIES = {f.__name__: f for f in (p1_found, p1_entities, p3_found, p3_pieces, p3_cover, p3_files, p4_found, p5_found, p5_classes, p6_containers, p6_check, p7_found, p8_found)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
