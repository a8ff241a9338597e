"""Data-quality queries over the filing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.functions import text
from filigree.operators import quality
from filigree.plans.catalog import Catalog, Tables
from filigree.plans.relational import _FILINGS_SQL, filed, plain

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles

REQUIRED = ["us-gaap:Assets", "us-gaap:Liabilities", "us-gaap:StockholdersEquity"]
POSITIVE = ["us-gaap:Assets", "us-gaap:Revenues", "us-gaap:CashOnHand", "us-gaap:SharesOutstanding"]
ITEMS = ["1", "1A", "7"]


@query(f"""with {_FILINGS_SQL} select replace(accession_number, '-', '') as accession_number, case when d < 0 then 'validation_error' else 'late_filing' end as issue_type, case when d < 0 then 'error' else 'warning' end as severity,
    case when d < 0 then 'period_of_report' else 'filing_date' end as field, cast(d as varchar) as actual
    from (select *, date_diff('day', period_of_report, filing_date) as d from filed) where d < 0 or (d > 120 and form_type = '10-K')""")
def dq_filing_dates(t: Tables) -> DataFrame:
    return quality.filing_dates(plain(filed(t)))


@query("""select replace(accession_number, '-', '') as accession_number, unnest(list_filter([case when value is null and value_text is null then 'no_value' end, case when abs(value) > 1000000000000000 then 'value_too_large' end,
    case when coalesce(trim(concept_name), '') = '' then 'blank_concept' end, case when period_type = 'duration' and period_start > period_end then 'period_reversed' end,
    case when not coalesce(period_type in ('instant', 'duration', 'forever'), false) then 'period_type' end], lambda x: x is not null)) as issue_type, 'warning' as severity, 'fact' as field, cast(null as varchar) as actual from facts""")
def dq_fact_rules(t: Tables) -> DataFrame:
    return quality.fact_rules(plain(t.facts))


@query(f"""with {_FILINGS_SQL}, w as (select replace(accession_number, '-', '') as acc, unnest({REQUIRED!r}) as c from filed)
    select acc as accession_number, 'missing_concept' as issue_type, 'warning' as severity, 'concept_name' as field, c as actual from w where not exists (select 1 from facts f where replace(f.accession_number, '-', '') = acc and f.concept_name = c)""")
def dq_required_concepts(t: Tables) -> DataFrame:
    return quality.required_concepts(plain(filed(t)), plain(t.facts), REQUIRED)


@query("""with f as (select replace(accession_number, '-', '') as acc, * from facts where concept_name in ('us-gaap:Assets', 'us-gaap:Liabilities', 'us-gaap:StockholdersEquity') and coalesce(cardinality(dimensions), 0) = 0),
    l as (select acc, concept_name, value::double as v from (select *, row_number() over (partition by acc, concept_name order by period_end desc nulls last, id) as n from f) where n = 1 and value is not null),
    p as (select acc, max(case when concept_name like '%Assets' then v end) as a, max(case when concept_name like '%Liabilities' then v end) as l, max(case when concept_name like '%Equity' then v end) as e from l group by 1),
    g as (select *, abs(a - coalesce(l, 0) - coalesce(e, 0)) / abs(a) as gap from p where a <> 0 and (l is not null or e is not null) and (l is null or l <> a))
    select acc as accession_number, 'balance' as issue_type, case when gap < 0.05 then 'warning' else 'error' end as severity, 'assets' as field from g where gap > 0.01""")
def dq_balance(t: Tables) -> DataFrame:
    return quality.balance(plain(t.facts), REQUIRED[:1], REQUIRED[1:2], REQUIRED[2:]).drop("actual")


@query(f"""select replace(accession_number, '-', '') as accession_number, 'negative_value' as issue_type, 'warning' as severity, 'value' as field, concept_name as actual from facts
    where concept_name in ({", ".join(map(repr, POSITIVE))}) and value < 0 and not coalesce(is_negated, false)""")
def dq_negative_values(t: Tables) -> DataFrame:
    return quality.negative_values(plain(t.facts), POSITIVE)


@query("""select accession_number, 'duplicate_facts' as issue_type, 'warning' as severity, 'facts' as field, cast(sum(n - 1)::bigint as varchar) as actual from (
    select replace(accession_number, '-', '') as accession_number, concept_name, period_start, period_end, list_sort(map_entries(dimensions)) as d, count(*) as n from facts group by all) group by 1 having sum(n - 1) > 0""")
def dq_duplicate_facts(t: Tables) -> DataFrame:
    return quality.duplicate_facts(plain(t.facts))


@query("select replace(accession_number, '-', '') as accession_number, 'fact_count' as issue_type, 'warning' as severity, 'facts' as field, cast(count(*) as varchar) as actual from facts group by 1 having count(*) not between 20 and 60")
def dq_completeness(t: Tables) -> DataFrame:
    return quality.completeness(plain(t.facts), 20, 60)


@query(rf"""with s as (select replace(accession_number, '-', '') as acc, item, case when markdown is null then 0 else len(regexp_extract_all(markdown, '\S+')) end as w from filing_sections)
    select acc as accession_number, 'short_section' as issue_type, 'warning' as severity, 'markdown' as field, cast(w as varchar) as actual from s where w > 0 and w < 100
    union all select acc, 'missing_section', 'warning', 'item', i from (select distinct acc, unnest({ITEMS!r}) as i from s) x where not exists (select 1 from s where s.acc = x.acc and s.item = x.i)""")
def dq_sections(t: Tables) -> DataFrame:
    return quality.section_rules(plain(t.filing_sections), text.word_count(F.col("markdown")), ITEMS)


@query(f"""with {_FILINGS_SQL}, d as (select replace(accession_number, '-', '') as acc, date_diff('day', period_of_report, filing_date) as d, form_type from filed),
    i as (select acc, 'error' as s from d where d < 0 union all select acc, 'warning' from d where d > 120 and form_type = '10-K'
    union all select replace(accession_number, '-', ''), 'warning' from facts where concept_name in ({", ".join(map(repr, POSITIVE))}) and value < 0 and not coalesce(is_negated, false))
    select acc as accession_number, count(case when s = 'error' then 1 end) as errors, count(case when s = 'warning' then 1 end) as warnings, count(case when s = 'error' then 1 end) = 0 as valid from i group by 1""")
def dq_verdict(t: Tables) -> DataFrame:
    return quality.verdict([quality.filing_dates(plain(filed(t))), quality.negative_values(plain(t.facts), POSITIVE)])


@query("""select count(*) as companies, count(case when company_name is null or trim(company_name) = '' then 1 end) as unnamed, count(case when not regexp_matches(upper(trim(ticker)), '^[A-Z0-9.\\-]{1,10}$') then 1 end) as bad_ticker,
    count(case when not regexp_matches(cik, '^0*[1-9][0-9]{0,9}$') then 1 end) as bad_cik from companies""".replace("\\\\", "\\"))
def dq_companies(t: Tables) -> DataFrame:
    from filigree.functions.identity import ticker

    name = F.col("company_name")
    return t.companies.agg(F.count("*").alias("companies"), F.count_if(name.isNull() | (F.trim(name) == "")).alias("unnamed"), F.count_if(F.col("ticker").isNotNull() & ticker(F.col("ticker")).isNull()).alias("bad_ticker"), F.count_if(~F.col("cik").rlike("^0*[1-9][0-9]{0,9}$")).alias("bad_cik"))
