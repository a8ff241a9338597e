"""Sectioning, chunking and incremental queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.operators import blocks, sections
from filigree.plans.catalog import Catalog, Tables
from filigree.plans.relational import _FILINGS_SQL, filed, plain
from filigree.streaming import ingest

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles


@query(f"with {_FILINGS_SQL} select distinct accession_number, ticker from filed join companies using (cik) where form_type in ('10-K', '10-K/A') and replace(accession_number, '-', '') in (select replace(accession_number, '-', '') from filing_sections)")
def ch_filings_to_chunk(t: Tables) -> DataFrame:
    rows = filed(t).where(F.col("form_type").isin("10-K", "10-K/A")).withColumn("acc", F.replace("accession_number", F.lit("-"), F.lit("")))
    held = plain(t.filing_sections).select(F.col("accession_number").alias("acc"))
    return rows.join(held, "acc", "left_semi").join(t.companies.select("cik", "ticker"), "cik").select("accession_number", "ticker").distinct()


@query()
def ch_chunks(t: Tables) -> DataFrame:
    """(key, chunk_index, text, token_count, contains_table): sections in chunks of whole blocks."""
    return blocks.chunk(t.filing_sections, "id", "markdown")


@query(r"""with p as (select id, list_filter(list_transform(string_split(trim(markdown, E' \t\r\n'), E'\n\n'), lambda x: trim(x, E' \t\r\n')), lambda x: x <> '') as parts from filing_sections where markdown is not null and not contains(lower(markdown), '<table'))
    select id, cast(len(parts) as integer) as blocks, cast(list_sum(list_transform(parts, lambda x: cast(floor(len(regexp_extract_all(x, '\S+')) * 1.33::double) as bigint))) as bigint) as tokens from p where len(parts) > 0""")
def ch_paragraph_blocks(t: Tables) -> DataFrame:
    """Blocks of sections without tables, with built-in functions alone."""
    clean = lambda c: F.regexp_replace(c, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    parts = F.filter(F.transform(F.split(clean(F.col("markdown")), "\n\n"), clean), lambda x: x != "")
    words = lambda x: F.size(F.regexp_extract_all(x, F.lit(r"(\S+)"), 1))
    rows = t.filing_sections.where(F.col("markdown").isNotNull() & ~F.lower("markdown").contains("<table")).select("id", parts.alias("parts")).where(F.size("parts") > 0)
    tokens = F.aggregate(F.transform("parts", lambda x: F.floor(words(x) * F.lit(1.33))), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return rows.select("id", F.size("parts").alias("blocks"), tokens.alias("tokens"))


def _reports(t: Tables) -> DataFrame:
    """Each filing's sections joined to one markdown, in the order of items."""
    rows = plain(t.filing_sections).where("markdown is not null").select("accession_number", F.struct(F.lpad(F.regexp_extract("item", r"(\d+)", 1), 2, "0").alias("o"), "item", "id", F.concat(F.lit("ITEM "), "item", F.lit(". "), F.coalesce("item_title", F.lit("")), F.lit("\n\n"), "markdown").alias("text")).alias("s"))
    whole = rows.groupBy("accession_number").agg(F.sort_array(F.collect_list("s")).alias("s"))
    return whole.select("accession_number", F.array_join(F.transform("s", lambda x: x["text"]), "\n\n").alias("markdown"))


@query()
def ds_items_by_pattern(t: Tables) -> DataFrame:
    """(key, item, text, how): items found again in the joined reports."""
    return sections.extract(_reports(t), "accession_number", "markdown", ["1", "1A", "7", "8", "10"])


@query()
def ds_split_at_items(t: Tables) -> DataFrame:
    return sections.split_at_items(_reports(t), "accession_number", "markdown")


@query("select id, case when length(markdown) > 1000 then 'table' when length(item_title) > 15 then 'pattern' when length(accession_number) > 15 then 'other' else 'none' end as tier from filing_sections")
def ds_tiers(t: Tables) -> DataFrame:
    return sections.tiers(t.filing_sections, F.col("markdown"), F.col("item_title"), F.col("accession_number")).select("id", "tier")


# Events and streams


@query("select time_bucket(interval '1 hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 6) as total from events group by 1, 2")
def st_hourly_windows(t: Tables) -> DataFrame:
    return ingest.windowed(t.events, "ts", ["event_type"], "1 hour", value="value").withColumn("total", F.round("total", 6))


@query("""with m as (select *, coalesce(ts - lag(ts) over (partition by user_id order by ts) >= interval '30 minutes', true) as fresh from events), s as (select *, sum(fresh::int) over (partition by user_id order by ts) as k from m)
    select min(ts) as session_start, max(ts) + interval '30 minutes' as session_end, user_id, count(*) as n from s group by user_id, k""")
def st_sessions(t: Tables) -> DataFrame:
    return ingest.sessions(t.events, "ts", ["user_id"], "30 minutes")


@query("select event_type, count(*) as n, round(sum(value), 6) as total from events group by 1")
def st_file_stream(t: Tables) -> DataFrame:
    """The events table read as a stream of files until it is drained, then counted."""
    out, mark = ingest.scratch(t.spark, "stream-out"), ingest.scratch(t.spark, "stream-mark")
    ingest.drain(ingest.file_stream(t.spark, t.sf_dir, t.events.schema, glob="events.parquet"), out, mark)
    return t.spark.read.schema(t.events.schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("select event_id, try_cast(json_extract(props, '$.k') as integer) as k from events")
def st_event_properties(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("select user_id, event_id, round(value - lag(value) over (partition by user_id order by ts, event_id), 6) as change from events")
def st_change_per_user(t: Tables) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("user_id", "event_id", F.round(F.col("value") - F.lag("value").over(order), 6).alias("change"))


# Orders and line items, for scans, joins and aggregates at the sizes of the benchmark


@query("""select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as discount, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2""")
def bm_line_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(revenue), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("n"))


@query("""select n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(distinct o_orderkey) as orders from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2""")
def bm_revenue_by_nation(t: Tables) -> DataFrame:
    """Lines are summed by order before they meet customers, so that the wide join carries one row an order."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    rows = t.orders.select("o_orderkey", "o_custkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.groupBy("o_custkey").agg(F.sum("revenue").alias("revenue"), F.countDistinct("o_orderkey").alias("orders"))
    rows = rows.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.groupBy("c_nationkey").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    rows = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("n_name", "r_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("orders").alias("orders"))


@query("select c_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as n from orders) join customer on o_custkey = c_custkey where n <= 3")
def bm_top_orders(t: Tables) -> DataFrame:
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(order).alias("n")).where("n <= 3")
    return rows.join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey", "o_totalprice")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def bm_orders_without_lines(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")
