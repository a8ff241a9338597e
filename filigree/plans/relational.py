"""Scans, filters, joins, aggregates, windows and set operations over filings, facts and sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filigree.functions import identity, text
from filigree.operators import upsert
from filigree.plans.catalog import Catalog, Tables

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles

#: One row per filing: the latest load.
_FILINGS_SQL = """filed as (
    select * exclude (cik), lpad(cik, 10, '0') as cik from filings
    qualify row_number() over (partition by replace(accession_number, '-', '') order by created_at desc nulls last, updated_at desc nulls last, edgar_url) = 1)"""
_PLAIN = "replace(trim(accession_number), '-', '')"
FORMS = ("10-K", "10-K/A")


def filed(t: Tables) -> DataFrame:
    """Filings once each, as loaded last, with padded cik."""
    order = [F.col("created_at").desc_nulls_last(), F.col("updated_at").desc_nulls_last(), F.col("edgar_url")]
    rows = t.filings.withColumn("_acc", identity.plain_accession(F.col("accession_number")))
    return upsert.latest(rows, ["_acc"], order).drop("_acc").withColumn("cik", F.lpad("cik", 10, "0"))


def plain(df: DataFrame) -> DataFrame:
    return df.withColumn("accession_number", identity.plain_accession(F.col("accession_number")))


@query("select cik, company_name, ticker from companies where cik = (select min(cik) from companies)")
def src_point_scan(t: Tables) -> DataFrame:
    first = t.companies.agg(F.min("cik").alias("cik"))
    return t.companies.join(F.broadcast(first), "cik", "left_semi").select("cik", "company_name", "ticker")


@query("select cik, company_name from companies where state_of_incorporation = 'DE' and company_name is not null")
def src_sql_with_parameters(t: Tables) -> DataFrame:
    return t.spark.sql("select cik, company_name from {companies} where state_of_incorporation = :state and company_name is not null", args={"state": "DE"}, companies=t.companies)


@query("select accession_number, cik, form_type from filings where coalesce(xbrl_processed, false) = false")
def src_unprocessed_queue(t: Tables) -> DataFrame:
    return t.filings.where(~F.coalesce("xbrl_processed", F.lit(False))).select("accession_number", "cik", "form_type")


@query("""select distinct ticker, alias from (
    select ticker, unnest([lower(ticker), lower(company_name), lower(split_part(company_name, ' ', 1))]) as alias from companies where ticker is not null and company_name is not null
) where length(alias) > 2""")
def src_company_aliases(t: Tables) -> DataFrame:
    named = t.companies.where("ticker is not null and company_name is not null")
    alias = F.explode(F.array(F.lower("ticker"), F.lower("company_name"), F.lower(F.get(F.split("company_name", " "), F.lit(0))))).alias("alias")
    return named.select("ticker", alias).where(F.length("alias") > 2).distinct()


@query("select distinct f.accession_number, '20' || substr(f.accession_number, 12, 2) || '/' || lpad(f.cik, 10, '0') || '_' || c.ticker || '/' || f.accession_number as path from filings f join companies c on lpad(f.cik, 10, '0') = c.cik where c.ticker is not null and f.accession_number like '%-%'")
def src_filing_path(t: Tables) -> DataFrame:
    rows = t.filings.withColumn("cik", F.lpad("cik", 10, "0")).join(t.companies.select("cik", "ticker"), "cik").where("ticker is not null and accession_number like '%-%'")
    path = F.concat_ws("/", identity.accession_year(F.col("accession_number")), F.concat_ws("_", "cik", "ticker"), "accession_number")
    return rows.select("accession_number", path.alias("path")).distinct()


@query("""select cik, case when nk then upper(company_name) else company_name end as company_name, coalesce(case when nk then null end, ticker) as ticker, state_of_incorporation
    from (select *, ticker is not null as nk from companies)
    union all select 'new' || cik, company_name, ticker, null from companies where ticker is null""")
def snk_upsert_companies(t: Tables) -> DataFrame:
    old = t.companies.select("cik", "company_name", "ticker", "state_of_incorporation")
    known = old.where("ticker is not null").select("cik", F.upper("company_name").alias("company_name"), F.lit(None).cast("string").alias("ticker"))
    fresh = old.where("ticker is null").select(F.concat(F.lit("new"), "cik").alias("cik"), "company_name", "ticker")
    return upsert.upsert(old, known.unionByName(fresh), ["cik"], overwrite=["company_name"], keep_known=["ticker"])


@query("""with keyed as (select *, replace(accession_number, '-', '') as acc, coalesce(cast(map_entries(dimensions) as varchar), '') as dims from facts),
    old as (select * from keyed where created_at < timestamp '2020-01-01'),
    new as (select * from keyed where created_at >= timestamp '2020-01-01' qualify row_number() over (partition by acc, concept_name, period_end, dims order by created_at, id) = 1)
    select n.id from new n where not exists (select 1 from old o where o.acc is not distinct from n.acc and o.concept_name is not distinct from n.concept_name and o.period_end is not distinct from n.period_end and o.dims = n.dims)""")
def snk_insert_absent_facts(t: Tables) -> DataFrame:
    dims = F.coalesce(F.to_json(F.map_entries("dimensions")), F.lit("[]"))
    keyed = t.facts.select("id", "concept_name", "period_end", "created_at", identity.plain_accession(F.col("accession_number")).alias("acc"), F.when(F.coalesce(F.size("dimensions"), F.lit(-1)) < 0, F.lit("")).otherwise(dims).alias("dims"))
    old, new = keyed.where("created_at < timestamp_ntz'2020-01-01'"), keyed.where("created_at >= timestamp_ntz'2020-01-01'")
    return upsert.absent(old, new, ["acc", "concept_name", "period_end", "dims"], [F.col("created_at"), F.col("id")]).select("id")


@query("""select id, case when word_count is null then -1 else word_count end as word_count, coalesce(item_title, '') as item_title from filing_sections""")
def snk_patch_sections(t: Tables) -> DataFrame:
    base = t.filing_sections.select("id", "word_count", "item_title")
    changes = base.where("word_count is null or item_title is null").select("id", F.when(F.col("word_count").isNull(), -1).alias("word_count"), F.when(F.col("item_title").isNull(), F.lit("")).alias("item_title"))
    return upsert.patch(base, changes, ["id"])


@query("""with f as (select id, replace(accession_number, '-', '') as acc, concept_name, period_end, value, cast(coalesce(decimals, -9) as integer) as confidence, created_at from facts where value is not null and period_end is not null),
    o as (select *, 0 as n from f where created_at < timestamp '2019-01-01'), w as (select *, 1 from f where created_at >= timestamp '2019-01-01')
    select acc, concept_name, period_end, id from (select * from o union all select * from w)
    qualify row_number() over (partition by acc, concept_name, period_end order by confidence desc, n desc, id desc) = 1""")
def snk_gated_upsert(t: Tables) -> DataFrame:
    rows = t.facts.where("value is not null and period_end is not null").select("id", identity.plain_accession(F.col("accession_number")).alias("acc"), "concept_name", "period_end", F.coalesce("decimals", F.lit(-9)).alias("confidence"), "created_at")
    old, new = rows.where("created_at < timestamp_ntz'2019-01-01'"), rows.where("created_at >= timestamp_ntz'2019-01-01'")
    return upsert.gated(old, new, ["acc", "concept_name", "period_end"], "confidence", "id").select("acc", "concept_name", "period_end", "id")


@query("""with new as (select id + 5000000000 as id, accession_number, item from filing_sections where item = '1A')
    select id, accession_number, item from filing_sections where accession_number not in (select accession_number from new) union all select * from new""")
def snk_replace_sections(t: Tables) -> DataFrame:
    old = t.filing_sections.select("id", "accession_number", "item")
    new = old.where("item = '1A'").withColumn("id", F.col("id") + F.lit(5_000_000_000))
    return upsert.replaced(old, new, ["accession_number"])


_ITEMS = ("1", "1A", "7", "8")


@query(f"""with {_FILINGS_SQL}, wanted as (select replace(accession_number, '-', '') as acc, unnest({list(_ITEMS)!r}) as item from filed)
    select acc, item from wanted where not exists (select 1 from filing_sections s where replace(s.accession_number, '-', '') = acc and s.item = wanted.item)""")
def snk_missing_sections(t: Tables) -> DataFrame:
    wanted = plain(filed(t)).select(F.col("accession_number").alias("acc"), F.explode(F.array(*map(F.lit, _ITEMS))).alias("item"))
    held = plain(t.filing_sections).select(F.col("accession_number").alias("acc"), "item").distinct()
    return wanted.join(held, ["acc", "item"], "left_anti")


@query("""select id from (select id, row_number() over (partition by accession_number, item order by created_at desc nulls last, id) as n from filing_sections) where n = 1""")
def snk_remove_duplicates(t: Tables) -> DataFrame:
    kept, _ = upsert.without_duplicates(t.filing_sections, ["accession_number", "item"], [F.col("created_at").desc_nulls_last(), F.col("id")])
    return kept.select("id")


@query("""with g as (select accession_number, item, count(*) as copies from filing_sections group by 1, 2 having count(*) > 1)
    select count(*) as duplicate_groups, cast(coalesce(sum(copies - 1), 0) as bigint) as rows_to_delete from g""")
def snk_duplicates_dry_run(t: Tables) -> DataFrame:
    return upsert.without_duplicates(t.filing_sections, ["accession_number", "item"], [F.col("id")])[1]


@query("select accession_number, filing_date from filings where form_type = '10-K' and filing_date between date '2015-01-01' and date '2018-12-31'")
def flt_form_and_dates(t: Tables) -> DataFrame:
    rows = t.filings.where((F.col("form_type") == "10-K") & F.col("filing_date").between("2015-01-01", "2018-12-31"))
    return rows.select("accession_number", "filing_date").orderBy(F.desc("filing_date"))


@query("select id, accession_number from facts where concept_name = 'us-gaap:Assets'")
def flt_facts_of_concept(t: Tables) -> DataFrame:
    return t.facts.where("concept_name = 'us-gaap:Assets'").select("id", "accession_number")


@query("select section, depth, concept_name from concept_categories where section = 'BalanceSheet'")
def flt_concepts_of_section(t: Tables) -> DataFrame:
    return t.concept_categories.where("section = 'BalanceSheet'").select("section", "depth", "concept_name").orderBy("depth", "concept_name")


@query("select id, cast(value as double) as value, coalesce(unit, 'USD') as unit from facts where concept_name in ('us-gaap:Assets', 'us-gaap:Revenues', 'us-gaap:NetResult') and value is not null")
def flt_key_metrics(t: Tables) -> DataFrame:
    rows = t.facts.where(F.col("concept_name").isin("us-gaap:Assets", "us-gaap:Revenues", "us-gaap:NetResult") & F.col("value").isNotNull())
    return rows.select("id", F.col("value").cast("double").alias("value"), F.coalesce("unit", F.lit("USD")).alias("unit"))


@query("select a.id as id_a, b.id as id_b from facts a join facts b on a.accession_number = b.accession_number and a.concept_name = b.concept_name and a.period_end is not distinct from b.period_end and a.unit is not distinct from b.unit and a.id < b.id where a.value_text is not null")
def flt_null_safe_equal(t: Tables) -> DataFrame:
    a = t.facts.where("value_text is not null").select(F.col("id").alias("id_a"), "accession_number", "concept_name", "period_end", "unit")
    b = t.facts.select(F.col("id").alias("id_b"), *[F.col(c).alias(f"b_{c}") for c in ("accession_number", "concept_name", "period_end", "unit")])
    on = (F.col("accession_number") == F.col("b_accession_number")) & (F.col("concept_name") == F.col("b_concept_name")) & F.col("period_end").eqNullSafe(F.col("b_period_end")) & F.col("unit").eqNullSafe(F.col("b_unit"))
    return a.join(b, on & (F.col("id_a") < F.col("id_b"))).select("id_a", "id_b")


@query("select concept_name, count(*) as n from facts where concept_name like '%Revenue%' group by 1")
def flt_like(t: Tables) -> DataFrame:
    return t.facts.where(F.col("concept_name").like("%Revenue%")).groupBy("concept_name").agg(F.count("*").alias("n"))


@query(f"""with {_FILINGS_SQL}, n as (select {_PLAIN} as acc, count(*) as n from filing_sections group by 1)
    select accession_number, coalesce(n, 0) as sections from filed left join n on replace(accession_number, '-', '') = acc where coalesce(n, 0) < 3 and year(filing_date) >= 2020""")
def flt_incomplete_filings(t: Tables) -> DataFrame:
    n = plain(t.filing_sections).groupBy(F.col("accession_number").alias("acc")).agg(F.count("*").alias("n"))
    rows = filed(t).withColumn("acc", identity.plain_accession(F.col("accession_number"))).join(n, "acc", "left")
    return rows.where((F.coalesce("n", F.lit(0)) < 3) & (F.year("filing_date") >= 2020)).select("accession_number", F.coalesce("n", F.lit(0)).alias("sections"))


@query(r"""select accession_number, primary_document, case
        when primary_document is null then 'none' when regexp_matches(lower(primary_document), '^ex.*') then 'skip' when regexp_matches(lower(primary_document), '\.(jpg|gif|png|xlsx?)$') then 'skip'
        when regexp_matches(lower(primary_document), '\.(htm|html|xml|xsd|txt)$') then 'keep' else 'skip' end as verdict from filings""")
def flt_document_rules(t: Tables) -> DataFrame:
    name = F.lower("primary_document")
    verdict = F.when(name.isNull(), "none").when(name.startswith("ex"), "skip").when(name.rlike(r"\.(jpg|gif|png|xlsx?)$"), "skip").when(name.rlike(r"\.(htm|html|xml|xsd|txt)$"), "keep").otherwise("skip")
    return t.filings.select("accession_number", "primary_document", verdict.alias("verdict"))


@query(r"""select id from filing_sections where markdown is not null and len(regexp_extract_all(markdown, '\S+')) >= 10""")
def flt_sections_with_words(t: Tables) -> DataFrame:
    return t.filing_sections.where(text.word_count(F.col("markdown")) >= 10).select("id")


@query("select distinct chunk_id from chunks where replace(accession_number, '-', '') not in (select replace(accession_number, '-', '') from facts)")
def flt_not_processed(t: Tables) -> DataFrame:
    done = plain(t.facts).select("accession_number").distinct()
    return plain(t.chunks).join(done, "accession_number", "left_anti").select("chunk_id").distinct()


@query("""select (select count(*) from companies) as companies, (select count(*) from filings) as filings, (select count(*) from filings where xbrl_processed) as processed, (select count(*) from facts) as facts, (select count(*) from filing_sections where markdown is not null) as sections""")
def flt_status_counts(t: Tables) -> DataFrame:
    counts = [
        t.companies.agg(F.count("*").alias("companies")), t.filings.agg(F.count("*").alias("filings"), F.count_if(F.coalesce("xbrl_processed", F.lit(False))).alias("processed")),
        t.facts.agg(F.count("*").alias("facts")), t.filing_sections.agg(F.count("markdown").alias("sections")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.join(c)  # tables of one row
    return out


@query(f"with {_FILINGS_SQL} select f.accession_number, c.company_name, c.ticker from filed f join companies c using (cik)")
def jn_filings_companies(t: Tables) -> DataFrame:
    return filed(t).join(t.companies.select("cik", "company_name", "ticker"), "cik").select("accession_number", "company_name", "ticker")


_KEY = ("Revenues", "NetResult", "Assets", "Liabilities", "StockholdersEquity")


def _measures(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.max(F.when(F.col("concept_name") == f"us-gaap:{k}", F.col("value"))).cast("double").alias(k.lower()) for k in _KEY])


@query(f"""with {_FILINGS_SQL}, f as (select *, replace(accession_number, '-', '') as acc from facts)
    select filed.accession_number, {", ".join(f"cast(max(case when concept_name = 'us-gaap:{k}' then value end) as double) as {k.lower()}" for k in _KEY)}
    from filed left join f on acc = replace(filed.accession_number, '-', '') and (period_type = 'instant' or (period_type = 'duration' and period_end = period_of_report)) and coalesce(cardinality(dimensions), 0) = 0
    group by 1""")
def jn_key_financials(t: Tables) -> DataFrame:
    """The disjunction over period types as two filters on one equi-join, so that no pair of all rows is made."""
    rows = filed(t).select("accession_number", "period_of_report", identity.plain_accession(F.col("accession_number")).alias("acc"))
    f = t.facts.where(F.col("concept_name").isin(*[f"us-gaap:{k}" for k in _KEY]) & (F.coalesce(F.size("dimensions"), F.lit(0)) <= 0) & F.col("period_type").isin("instant", "duration"))
    f = f.select(identity.plain_accession(F.col("accession_number")).alias("acc"), "concept_name", "period_type", "period_end", "value")
    joined = rows.join(f, "acc", "left")
    fits = (F.col("period_type") == "instant") | (F.col("period_end") == F.col("period_of_report"))
    return _measures(joined.withColumn("concept_name", F.when(fits, F.col("concept_name"))), ["accession_number"])


@query(f"""with {_FILINGS_SQL}, d as (select period_end, concept_name, max(value) as v from facts where period_type = 'duration' and period_end is not null group by 1, 2),
    i as (select replace(accession_number, '-', '') as acc, concept_name, max(value) as v from facts where period_type = 'instant' and dimensions is null group by 1, 2)
    select accession_number, {", ".join(f"cast(greatest(max(case when d.concept_name = 'us-gaap:{k}' then d.v end), max(case when i.concept_name = 'us-gaap:{k}' then i.v end)) as double) as {k.lower()}" for k in _KEY)}
    from filed left join d on d.period_end = period_of_report left join i on i.acc = replace(accession_number, '-', '') group by 1""")
def jn_key_financials_as_written(t: Tables) -> DataFrame:
    """Where OR binds last, durations of any company with the same end join; each branch is aggregated on its own key first."""
    rows = filed(t).select("accession_number", "period_of_report", identity.plain_accession(F.col("accession_number")).alias("acc"))
    f = t.facts.where(F.col("concept_name").isin(*[f"us-gaap:{k}" for k in _KEY]))
    durations = _measures(f.where("period_type = 'duration' and period_end is not null"), ["period_end"]).withColumnRenamed("period_end", "period_of_report")
    instants = _measures(plain(f.where("period_type = 'instant' and dimensions is null")), ["accession_number"]).withColumnRenamed("accession_number", "acc")
    out = rows.join(durations.withColumnsRenamed({k.lower(): f"d_{k}" for k in _KEY}), "period_of_report", "left").join(instants.withColumnsRenamed({k.lower(): f"i_{k}" for k in _KEY}), "acc", "left")
    return out.select("accession_number", *[F.greatest(f"d_{k}", f"i_{k}").alias(k.lower()) for k in _KEY])


@query(f"""with {_FILINGS_SQL} select cik, concept_name, period_end, cast(value as double) as value, f.id from facts f join filed on replace(f.accession_number, '-', '') = replace(filed.accession_number, '-', '')
    where concept_name = 'us-gaap:Revenues' and value is not null""")
def jn_fact_history(t: Tables) -> DataFrame:
    f = plain(t.facts.where("concept_name = 'us-gaap:Revenues' and value is not null")).select("id", "accession_number", "concept_name", "period_end", F.col("value").cast("double").alias("value"))
    return f.join(plain(filed(t)).select("accession_number", "cik"), "accession_number").select("cik", "concept_name", "period_end", "value", "id")


@query(f"with {_FILINGS_SQL} select s.id, s.item, c.ticker, filed.filing_date from filing_sections s join filed on replace(s.accession_number, '-', '') = replace(filed.accession_number, '-', '') join companies c using (cik)")
def jn_sections_filings_companies(t: Tables) -> DataFrame:
    rows = plain(t.filing_sections).select("id", "item", "accession_number").join(plain(filed(t)).select("accession_number", "cik", "filing_date"), "accession_number")
    return rows.join(t.companies.select("cik", "ticker"), "cik").select("id", "item", "ticker", "filing_date")


@query(f"with {_FILINGS_SQL} select accession_number from filed where replace(accession_number, '-', '') not in (select {_PLAIN} from filing_sections where accession_number is not null)")
def jn_filings_without_sections(t: Tables) -> DataFrame:
    held = plain(t.filing_sections).select(F.col("accession_number").alias("acc"))
    rows = filed(t).withColumn("acc", identity.plain_accession(F.col("accession_number")))
    return rows.join(held, "acc", "left_anti").select("accession_number")


@query(f"with {_FILINGS_SQL} select accession_number, cik, form_type from filed f where filing_date = (select max(filing_date) from filed g where g.cik = f.cik and g.form_type = f.form_type)")
def jn_latest_filings(t: Tables) -> DataFrame:
    rows = filed(t).withColumn("last", F.max("filing_date").over(Window.partitionBy("cik", "form_type")))
    return rows.where("filing_date = last").select("accession_number", "cik", "form_type")


@query(r"""select f.id, coalesce(c.label, trim(regexp_replace(f.concept_local_name, '([A-Z])', ' \1', 'g'))) as label, c.depth from facts f left join concept_categories c using (concept_name)""")
def jn_facts_with_labels(t: Tables) -> DataFrame:
    labels = t.concept_categories.select("concept_name", F.col("label").alias("listed"), F.col("depth").alias("level"))
    rows = t.facts.select("id", "concept_name", "concept_local_name").join(labels, "concept_name", "left")
    return rows.select("id", F.coalesce("listed", text.camel_label(F.col("concept_local_name"))).alias("label"), F.col("level").alias("depth"))


@query("""select ticker, company_name, form_type, count(*) as filings, count(case when xbrl_processed then 1 end) as processed, min(filing_date) as first_filed, max(filing_date) as last_filed
    from filings f join companies c on lpad(f.cik, 10, '0') = c.cik group by 1, 2, 3""")
def ag_processing_summary(t: Tables) -> DataFrame:
    rows = t.filings.withColumn("cik", F.lpad("cik", 10, "0")).join(t.companies.select("cik", "ticker", "company_name"), "cik")
    return rows.groupBy("ticker", "company_name", "form_type").agg(F.count("*").alias("filings"), F.count_if("xbrl_processed").alias("processed"), F.min("filing_date").alias("first_filed"), F.max("filing_date").alias("last_filed"))


@query("select replace(accession_number, '-', '') as acc, cast(max(year(period_end)) as integer) as last_year from facts group by 1")
def ag_last_year(t: Tables) -> DataFrame:
    return plain(t.facts).groupBy(F.col("accession_number").alias("acc")).agg(F.max(F.year("period_end")).alias("last_year"))


@query("select replace(accession_number, '-', '') as acc, concept_name, period_end, count(*) as n from facts group by 1, 2, 3 having count(*) > 1")
def ag_duplicate_keys(t: Tables) -> DataFrame:
    return plain(t.facts).groupBy(F.col("accession_number").alias("acc"), "concept_name", "period_end").agg(F.count("*").alias("n")).where("n > 1")


@query("select id, row_number() over w = 1 as keep, count(*) over (partition by replace(accession_number, '-', ''), concept_name, period_end) as copies from facts window w as (partition by replace(accession_number, '-', ''), concept_name, period_end order by decimals desc nulls last, created_at desc, id) qualify copies > 1")
def ag_duplicate_details(t: Tables) -> DataFrame:
    key = Window.partitionBy("accession_number", "concept_name", "period_end")
    order = key.orderBy(F.col("decimals").desc_nulls_last(), F.col("created_at").desc_nulls_last(), "id")
    return plain(t.facts).select("id", (F.row_number().over(order) == 1).alias("keep"), F.count("*").over(key).alias("copies")).where("copies > 1")


@query("select item, count(*) as sections, cast(sum(length(markdown)) as bigint) as characters from filing_sections group by 1")
def ag_sections_by_item(t: Tables) -> DataFrame:
    return t.filing_sections.groupBy("item").agg(F.count("*").alias("sections"), F.sum(F.length("markdown")).alias("characters"))


@query("select distinct ticker, state_of_incorporation from companies")
def ag_distinct(t: Tables) -> DataFrame:
    return t.companies.select("ticker", "state_of_incorporation").distinct()


@query("""select acc, period_end from (select replace(accession_number, '-', '') as acc, period_end, count(*) as n from facts where period_end is not null group by 1, 2)
    qualify row_number() over (partition by acc order by n desc, period_end) = 1""")
def ag_mode_of_period_end(t: Tables) -> DataFrame:
    n = plain(t.facts.where("period_end is not null")).groupBy(F.col("accession_number").alias("acc"), "period_end").agg(F.count("*").alias("n"))
    return upsert.latest(n, ["acc"], [F.desc("n"), F.col("period_end")]).select("acc", "period_end")


@query("""select count(*) as chunks, cast(sum(token_count) as bigint) as tokens, count(case when contains_table then 1 end) as tables, cast(floor(sum(token_count) / count(token_count)) as bigint) as average, round(sum(token_count) / 1e6 * 0.13, 2) as cost from chunks""")
def ag_chunk_totals(t: Tables) -> DataFrame:
    total = F.sum("token_count")
    return t.chunks.agg(F.count("*").alias("chunks"), total.alias("tokens"), F.count_if("contains_table").alias("tables"), F.floor(total / F.count("token_count")).alias("average"), F.round(total / F.lit(1e6) * 0.13, 2).alias("cost"))


@query(f"""with {_FILINGS_SQL} select accession_number, cik, n from (select accession_number, cik, row_number() over (partition by cik, year(period_of_report) order by (form_type like '%/A') desc, filing_date desc nulls last, accession_number desc) as n from filed where period_of_report is not null) where n = 1""")
def wn_best_filing_of_year(t: Tables) -> DataFrame:
    order = Window.partitionBy("cik", F.year("period_of_report")).orderBy(F.col("form_type").like("%/A").desc(), F.col("filing_date").desc_nulls_last(), F.desc("accession_number"))
    return filed(t).where("period_of_report is not null").select("accession_number", "cik", F.row_number().over(order).alias("n")).where("n = 1")


@query("""with f as (select replace(accession_number, '-', '') as acc, concept_name, value, period_end, id from facts where coalesce(cardinality(dimensions), 0) = 0 and concept_name in ('us-gaap:Liabilities', 'us-gaap:StockholdersEquity')),
    l as (select * from f qualify row_number() over (partition by acc, concept_name order by coalesce(period_end, date '0001-01-01') desc, id) = 1)
    select acc, concept_name, cast(value as double) as value from l where value is not null qualify row_number() over (partition by acc order by concept_name = 'us-gaap:Liabilities' desc) = 1""")
def wn_primary_value(t: Tables) -> DataFrame:
    f = plain(t.facts).where((F.coalesce(F.size("dimensions"), F.lit(0)) <= 0) & F.col("concept_name").isin("us-gaap:Liabilities", "us-gaap:StockholdersEquity"))
    f = f.select(F.col("accession_number").alias("acc"), "concept_name", "value", "id", F.coalesce("period_end", F.lit("0001-01-01").cast("date")).alias("at"))
    last = upsert.latest(f, ["acc", "concept_name"], [F.desc("at"), F.col("id")]).where("value is not null")
    return upsert.latest(last, ["acc"], [(F.col("concept_name") == "us-gaap:Liabilities").desc()]).select("acc", "concept_name", F.col("value").cast("double").alias("value"))


@query("select concept_name, id, cast(value as double) as value from facts where value is not null and concept_name like 'us-gaap:%' qualify row_number() over (partition by concept_name order by value desc, id) <= 3")
def tk_top_facts_per_concept(t: Tables) -> DataFrame:
    rows = t.facts.where("value is not null and concept_name like 'us-gaap:%'").select("concept_name", "id", "value")
    order = Window.partitionBy("concept_name").orderBy(F.desc("value"), "id")
    return rows.withColumn("n", F.row_number().over(order)).where("n <= 3").select("concept_name", "id", F.col("value").cast("double").alias("value"))


@query("select id, cast(value as double) as value from facts where value is not null order by value desc, id limit 20")
def tk_limit(t: Tables) -> DataFrame:
    return t.facts.where("value is not null").orderBy(F.desc("value"), "id").limit(20).select("id", F.col("value").cast("double").alias("value"))


@query(f"""select distinct accession_number from (select accession_number from filings where download_status = 'failed' union select accession_number from filings where replace(accession_number, '-', '') not in (select {_PLAIN} from filing_sections where accession_number is not null))""")
def se_union_of_failed_and_orphaned(t: Tables) -> DataFrame:
    held = plain(t.filing_sections).select(F.col("accession_number").alias("acc"))
    orphans = t.filings.withColumn("acc", identity.plain_accession(F.col("accession_number"))).join(held, "acc", "left_anti").select("accession_number")
    return t.filings.where("download_status = 'failed'").select("accession_number").union(orphans).distinct()


@query("select concept_name from concept_categories except select concept_name from facts")
def se_difference(t: Tables) -> DataFrame:
    return t.concept_categories.select("concept_name").subtract(t.facts.select("concept_name"))


@query("select id from facts where concept_name in (select concept_name from concept_categories where depth = 0)")
def se_membership(t: Tables) -> DataFrame:
    return t.facts.join(t.concept_categories.where("depth = 0").select("concept_name"), "concept_name", "left_semi").select("id")


@query(r"""with w as (select id, markdown, case when markdown is null then 0 else len(regexp_extract_all(markdown, '\S+')) end as n from filing_sections)
    select id, cast(n as integer) as words, cast(floor(n * 1.33::double) as integer) as tokens, least(100.0::double, n / 50000.0::double * 100) as quality, cast(length(markdown) as integer) as characters, substr(markdown, 1, 80) as preview from w""")
def sc_text_measures(t: Tables) -> DataFrame:
    words = text.word_count(F.col("markdown"))
    return t.filing_sections.select("id", words.alias("words"), text.token_estimate(F.col("markdown")).alias("tokens"), text.quality_score(words).alias("quality"), F.length("markdown").alias("characters"), F.substring("markdown", 1, 80).alias("preview"))


@query(r"""select id, try_cast(replace(trim(value_text), ',', '') as decimal(20,4))::double as number, try_strptime(value_text, '%Y-%m-%d')::date as day, trim(regexp_replace(concept_local_name, '([A-Z])', ' \1', 'g')) as label,
    cast(date_diff('day', period_start, period_end) as integer) as days, cast(year(period_end) as integer) as year from facts where value_text is null or regexp_matches(value_text, '^\d{4}-\d\d-\d\d$') or regexp_matches(value_text, '^[0-9,]+$')""")
def sc_readings(t: Tables) -> DataFrame:
    rows = t.facts.where(F.col("value_text").isNull() | F.col("value_text").rlike(r"^\d{4}-\d\d-\d\d$") | F.col("value_text").rlike("^[0-9,]+$"))
    day = F.try_to_timestamp("value_text", F.lit("yyyy-MM-dd")).cast("date")
    return rows.select("id", text.plain_number(F.col("value_text")).cast("double").alias("number"), day.alias("day"), text.camel_label(F.col("concept_local_name")).alias("label"), F.datediff("period_end", "period_start").alias("days"), F.year("period_end").alias("year"))


@query(r"""select chunk_id, regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', 'x', 'g'), '\b([A-Z]{2,5})\b', 1) as found from (select distinct chunk_id, text from chunks)""")
def sc_ticker_like_words(t: Tables) -> DataFrame:
    return t.chunks.select("chunk_id", "text").distinct().select("chunk_id", text.ticker_like(F.col("text"), []).alias("found"))
