"""The wide table of facts: one row per filing and period end, a column per listed concept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions import readings
from filigree.operators import wide
from filigree.runtime import broadcast_within, dashed_accession, table

ENTITY = ["accession_number", "period_end"]
#: data_type of a concept to the kind of its column.
KIND_OF = {"monetary": "number", "shares": "number", "perShare": "number", "pure": "number", "boolean": "boolean", "date": "date", "string": "text"}
LISTED_ROWS = 100_000


def concept_key(name):
    """Spellings of one concept that differ in case, blanks or the sign after the prefix have one key."""
    return F.replace(F.lower(F.regexp_replace(name, r"\s+", "")), F.lit("_"), F.lit(":"))


def concept_cells(facts: DataFrame, listed: DataFrame) -> DataFrame:
    names = listed.where("concept_name is not null").groupBy(concept_key(F.col("concept_name")).alias("name_key")).agg(F.min(F.struct("concept_name", "data_type")).alias("c"))
    names = names.select("name_key", F.col("c.concept_name").alias("listed"), F.col("c.data_type").alias("data_type"))
    usable = facts.where("period_end is not null and concept_name is not null and accession_number is not null and coalesce(cardinality(dimensions), 0) <= 0")
    rows = usable.select("id", "accession_number", "period_end", "concept_name", "value", "value_text", "created_at", concept_key(F.col("concept_name")).alias("name_key"))
    rows = rows.join(broadcast_within(names, LISTED_ROWS), "name_key", "left")
    kind = F.col("data_type")
    number = F.coalesce(F.col("value").cast(readings.NUMBER), F.when(F.col("value").isNull(), readings.number(F.col("value_text"))))
    text = readings.filled(F.col("value_text"))
    unlisted = F.col("listed").isNull()
    rows = rows.select(
        "id", dashed_accession(F.col("accession_number")).alias("accession_number"), "period_end", "created_at", F.coalesce("listed", "concept_name").alias("concept"),
        F.when(kind.isin("monetary", "shares", "perShare", "pure"), number).alias("n"),
        F.when(unlisted, F.coalesce(F.col("value").cast("string"), text)).when(kind == "string", text).alias("t"),
        F.when(kind == "boolean", readings.boolean(F.col("value_text"))).alias("b"),
        F.when(kind == "date", readings.date(F.col("value_text"))).alias("d"),
    )
    rows = rows.where("n is not null or t is not null or b is not null or d is not null")
    return wide.cells(rows, ENTITY, "concept", {h: h for h in "ntbd"}, "created_at", "id")


def p2_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "concept_categories")
    rows = listed.where("concept_name is not null").select("concept_name", "data_type").distinct().orderBy("concept_name").collect()  # the columns of the result
    schema = {r.concept_name: KIND_OF[r.data_type] for r in rows if r.data_type in KIND_OF}
    return wide.widen(concept_cells(table(spark, sf_dir, "facts"), listed), ENTITY, schema)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wide.filled_cells(p2_wide_table(spark, sf_dir), ENTITY)
    return found.select("accession_number", F.date_format("period_end", "yyyy-MM-dd").alias("period_end"), F.col("attribute").alias("concept_name"), "id")


def p2_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(concept_name, cells): values in each typed column of the wide table."""
    whole = p2_wide_table(spark, sf_dir)
    rows = table(spark, sf_dir, "concept_categories").select("concept_name", "data_type").distinct().collect()  # the columns of the result
    names = sorted(r.concept_name for r in rows if r.concept_name is not None and r.data_type in KIND_OF)
    counts = whole.agg(*[F.count(wide.column_name(c)).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("concept_name"), F.col(f"`{c}`").alias("cells")) for c in names]))).where("cells > 0")


_NUMBER_SQL = r"""
    regexp_matches(
        regexp_replace(regexp_replace(trim(regexp_replace(value_text, '\s+', ' ', 'g')), '^\((.*)\)$', '\1'), '^([+-]?) ?([$€£¥]|[A-Z]{3}\b)? ?([+-]?)', ''),
        '^ ?(([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]*)?|\.[0-9]+|[0-9]{1,3}( [0-9]{3})+([.,][0-9]+)?|[0-9]{1,3}(\.[0-9]{3})+,[0-9]+|[0-9]{1,3}(\.[0-9]{3}){2,}|[0-9]+,[0-9]+) ?%?$')"""
_DATE_SQL = "coalesce(" + ", ".join(f"try_strptime(trim(value_text), '{p}')" for p in ("%Y-%m-%d", "%Y/%m/%d", "%B %d, %Y", "%d %B %Y")) + ") is not null"

_CELLS_SQL = rf"""
        with named as (
            select f.id, f.accession_number, f.period_end, f.created_at, f.value, f.value_text, coalesce(c.concept_name, f.concept_name) as concept, c.concept_name is null as unlisted, c.data_type
            from facts f
            left join concept_categories c on replace(lower(regexp_replace(f.concept_name, '\s+', '', 'g')), '_', ':') = replace(lower(c.concept_name), '_', ':')
            where f.period_end is not null and f.concept_name is not null and f.accession_number is not null and coalesce(cardinality(f.dimensions), 0) = 0
        ), readable as (
            select *, regexp_replace(trim(accession_number), '^(\d{{10}})-?(\d{{2}})-?(\d{{6}})$', '\1-\2-\3') as acc from named
            where case
                when unlisted then value is not null or trim(value_text) <> ''
                when data_type in ('monetary', 'shares', 'perShare', 'pure') then value is not null or {_NUMBER_SQL}
                when data_type = 'boolean' then lower(trim(value_text)) in ('true', 'false', 'yes', 'no')
                when data_type = 'date' then {_DATE_SQL}
                else trim(value_text) <> '' end
        )"""

QUERIES = {"p2_found": p2_found, "p2_wide_table": p2_wide_table, "p2_column_counts": p2_column_counts}
ORACLES = {
    "p2_found": f"""
        {_CELLS_SQL}
        select acc as accession_number, strftime(period_end, '%Y-%m-%d') as period_end, concept as concept_name, id from readable
        qualify row_number() over (partition by acc, period_end, concept order by created_at desc nulls last, id) = 1""",
    "p2_column_counts": f"""
        {_CELLS_SQL}
        select concept as concept_name, count(*) as cells from (
            select acc, period_end, concept, unlisted from readable qualify row_number() over (partition by acc, period_end, concept order by created_at desc nulls last, id) = 1
        ) where not unlisted group by 1""",
}
