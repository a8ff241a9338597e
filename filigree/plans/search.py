"""Search, routing and entity queries over chunks, sections and questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.operators import entities, retrieval, routing
from filigree.plans.catalog import Catalog, Tables
from filigree.plans.passages import _ALL_CTE, _CHUNKS_SQL, chunks, local_edges

catalog = Catalog()
query = catalog.query
QUERIES, ORACLES = catalog.queries, catalog.oracles

_QUESTION = "warranty costs tax credits"
_WORDS = _QUESTION.split()


def _chunks(t: Tables) -> DataFrame:
    return chunks(t).select(F.col("chunk_id").alias("id"), "text", "embedding", "section_item", "accession_number")


def _probe(t: Tables) -> DataFrame:
    """The vector of the first chunk that has one, as the query."""
    first = chunks(t).where(F.exists("embedding", lambda x: x != 0)).agg(F.min_by("embedding", "chunk_id").alias("vector"))
    return first


_DOT = "list_dot_product({0}::double[], {1}::double[])"
_SCORED_SQL = f"""probe as (select embedding as p from chunk where {_DOT.format("embedding", "embedding")} > 0 order by chunk_id limit 1),
    scored as (select chunk_id as id, section_item, {_DOT.format("embedding", "p")} / (sqrt({_DOT.format("embedding", "embedding")}) * sqrt({_DOT.format("p", "p")})) as score from chunk, probe where {_DOT.format("embedding", "embedding")} > 0)"""
_VECTOR_SQL = f"{_CHUNKS_SQL}, {_SCORED_SQL}"
_BM25_SQL = f"""words as (select chunk_id as id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')) as term from chunk where text is not null),
    tf as (select term, id, count(*) as tf from words group by 1, 2), len as (select id, count(*) as length from words group by 1), total as (select count(*) as docs, avg(length) as mean from len),
    df as (select term, count(*) as df from tf where term in ({", ".join(map(repr, _WORDS))}) group by 1),
    raw as (select id, sum(ln(1 + (docs - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * length / mean))) as raw from tf join df using (term) join len using (id), total group by 1),
    keyword as (select id, raw / max(raw) over () as score from (select * from raw order by raw desc, id limit {{k}}))"""


@query(f"with {_VECTOR_SQL} select id, round(score, 9) as score from scored order by scored.score desc, id limit 20")
def vs_top_chunks(t: Tables) -> DataFrame:
    return retrieval.vector_search(_chunks(t), _probe(t), 20).withColumn("score", F.round("score", 9))


@query(f"with {_VECTOR_SQL} select id, round(score, 9) as score from scored where section_item = '7' and score >= 0.1 order by scored.score desc, id limit 10")
def vs_filtered(t: Tables) -> DataFrame:
    return retrieval.vector_search(_chunks(t), _probe(t), 10, least=0.1, where=F.col("section_item") == "7").withColumn("score", F.round("score", 9))


@query("""select vec_id, round(score, 9) as score from (select b.vec_id, list_dot_product(a.embedding::double[], b.embedding::double[]) / (sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) * sqrt(list_dot_product(b.embedding::double[], b.embedding::double[]))) as score
    from (select embedding from embeddings order by vec_id limit 1) a, embeddings b) order by score desc, vec_id limit 20""")
def vs_top_embeddings(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    probe = t.embeddings.agg(F.min_by("embedding", "vec_id").alias("vector"))
    return retrieval.vector_search(rows, probe, 20).select(F.col("id").alias("vec_id"), F.round("score", 9).alias("score"))


def _probes(rows: DataFrame) -> DataFrame:
    """The queries of a search: one row in a hundred, by a hash where ids are not numbers."""
    numbers = dict(rows.dtypes)["id"] in ("int", "bigint")
    place = F.col("id") if numbers else F.xxhash64("id")
    return rows.where(F.pmod(place, F.lit(100)) == 0).select(F.col("id").alias("query"), F.col("embedding").alias("vector"))


@query()
def vs_top_embeddings_each(t: Tables) -> DataFrame:
    """(query, id, score): ``vs_top_embeddings`` for every vec_id divisible by 100."""
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return retrieval.nearest(_probes(rows), rows, 20).withColumn("score", F.round("score", 9))


@query()
def vs_top_chunks_each(t: Tables) -> DataFrame:
    """(query, id, score): ``vs_top_chunks`` for one chunk in a hundred."""
    rows = _chunks(t).select("id", "embedding")
    return retrieval.nearest(_probes(rows), rows, 20).withColumn("score", F.round("score", 9))


@query()
def vs_filtered_each(t: Tables) -> DataFrame:
    """(query, id, score): ``vs_filtered`` for one chunk in a hundred of all sections."""
    rows = _chunks(t).select("id", "embedding", "section_item")
    return retrieval.nearest(_probes(rows), rows.where("section_item = '7'"), 10, least=0.1).withColumn("score", F.round("score", 9))


@query(f"with {_CHUNKS_SQL}, {_BM25_SQL.replace('{k}', '20')} select id, round(score, 9) as score from keyword")
def kw_bm25(t: Tables) -> DataFrame:
    return retrieval.keyword_search(retrieval.postings(_chunks(t)), _WORDS, 20).withColumn("score", F.round("score", 9))


@query()
def kw_bm25_each(t: Tables) -> DataFrame:
    """(query, id, score): ``kw_bm25`` for every question of eval_items."""
    questions = t.eval_items.select(F.col("item_id").alias("query"), F.col("question").alias("text"))
    return retrieval.keyword_search_each(retrieval.postings(_chunks(t)), questions, 20).withColumn("score", F.round("score", 9))


@query(f"with {_CHUNKS_SQL} select count(*) as documents, count(text) as with_text, count(section_title) as with_title, count(distinct section_item) as items from chunk")
def kw_statistics(t: Tables) -> DataFrame:
    return chunks(t).agg(F.count("*").alias("documents"), F.count("text").alias("with_text"), F.count("section_title").alias("with_title"), F.countDistinct("section_item").alias("items"))


_HYBRID_SQL = f"""{_VECTOR_SQL}, {_BM25_SQL.replace('{k}', '10')}, hits as (
    select id, score * 0.7::double as score, 0 as turn from (select id, score from scored order by scored.score desc, id limit 40) union all select id, score * 0.3::double, 1 from keyword),
    hybrid as (select id, sum(score) as score, list_transform(list_sort(list(turn)), lambda x: case x when 0 then 'vector' else 'keyword' end) as sources from hits group by 1)"""


@query(f"with {_HYBRID_SQL} select id, round(score, 9) as score, sources from hybrid order by hybrid.score desc, id limit 20")
def hy_hybrid(t: Tables) -> DataFrame:
    rows = _chunks(t)
    return retrieval.hybrid(rows, retrieval.postings(rows), _probe(t), _QUESTION, 20).select("id", F.round("score", 9).alias("score"), "sources")


@query()
def hy_reranked(t: Tables) -> DataFrame:
    rows = _chunks(t)
    return retrieval.hybrid(rows, retrieval.postings(rows), _probe(t), _QUESTION, 20, retrieval.lexical_rerank(rows, _QUESTION))


@query(f"""with {_ALL_CTE}, {_SCORED_SQL},
    near as (select src, dst, weight from edges union all select dst, src, weight from edges),
    seed as (select id, score from scored order by scored.score desc, id limit 10),
    h1 as (select dst as id, max(weight) as weight from (select src, dst, weight, row_number() over (partition by src order by weight desc, dst) as n from near where src in (select id from seed) and dst not in (select id from seed) and weight >= 0.4) where n <= 15 group by 1 order by 2 desc, 1 limit 30),
    k1 as (select * from h1 order by weight desc, id limit 5),
    h2 as (select dst as id, max(weight) as weight from (select src, dst, weight, row_number() over (partition by src order by weight desc, dst) as n from near where src in (select id from k1) and dst not in (select id from seed) and dst not in (select id from h1) and weight >= 0.4) where n <= 15 group by 1 order by 2 desc, 1 limit 30),
    k2 as (select * from h2 order by weight desc, id limit 5)
    select id, round(score, 9) as score, 0 as hop from seed union all select id, round(weight * 0.85, 9), 1 from k1 union all select id, round(weight * 0.85 * 0.85, 9), 2 from k2""")
def hr_multi_hop(t: Tables) -> DataFrame:
    seeds = retrieval.vector_search(_chunks(t), _probe(t), 10)
    return retrieval.multi_hop(seeds, local_edges(t), hops=2).withColumn("score", F.round("score", 9))


@query(f"with {_VECTOR_SQL} select id, round(score, 9) as score from (select *, row_number() over (partition by section_item order by score desc, id) as n from scored) where n <= 3")
def hr_quota_per_section(t: Tables) -> DataFrame:
    rows = _chunks(t)
    hits = retrieval.vector_scores(rows, _probe(t)).join(rows.select("id", "section_item"), "id")
    return retrieval.quota(hits, "section_item", 4).select("id", F.round("score", 9).alias("score"))


def _questions(t: Tables) -> DataFrame:
    return t.eval_items.select(F.col("item_id").alias("id"), "question")


def _aliases(t: Tables) -> DataFrame:
    word = F.explode(F.split(F.lower("company_name"), r"[^\p{L}\p{N}]+")).alias("alias")
    return t.companies.where("company_name is not null").select(F.lpad("cik", 10, "0").alias("company"), word).where("length(alias) > 4")


_ROUTE_SQL = r"""q as (select item_id as id, question from eval_items), w as (select distinct id, unnest(list_filter(regexp_split_to_array(lower(question), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as alias from q),
    a as (select distinct company, alias from (select lpad(cik, 10, '0') as company, unnest(regexp_split_to_array(lower(company_name), '[^\p{L}\p{N}]+')) as alias from companies where company_name is not null) where length(alias) > 4),
    c as (select id, list_sort(list_distinct(list(company))) as companies from w join a using (alias) group by 1),
    d as (select id, question, coalesce(companies, []) as companies from q left join c using (id)),
    f as (select *, regexp_matches(question, '(?i)\b(compare|compared|versus|vs|between|differ|difference|than|across|both)\b') as cmp, regexp_matches(question, '(?i)\b(why|how|explain|reason|cause|impact|affect|trend|relationship|strategy|driver)\b') as hard,
        regexp_matches(question, '(?i)\b(what|which|who|when|where|is|was|does|did)\b') as plain, len(regexp_extract_all(question, '\S+')) as n from d),
    r as (select id, question, companies, case when len(companies) >= 2 then 1 when len(companies) = 1 and cmp then 2 when hard and not plain then 3 when plain and n <= 12 and not hard then 4 else 5 end as rule from f)"""


@query(f"""with {_ROUTE_SQL} select id, case when rule <= 2 then 'cross_filing' when rule = 4 then 'simple' else 'complex' end as kind, [0.9, 0.75, 0.8, 0.85, 0.5][rule]::double as confidence, [3, 3, 2, 0, 2][rule] as hops, companies from r""")
def qr_route(t: Tables) -> DataFrame:
    return routing.route(routing.detect(_questions(t), _aliases(t)))


@query(f"""with {_ROUTE_SQL}, p as (select id, case when rule <= 2 and len(companies) > 0 then list_transform(companies[1:4], lambda c: question || ' [' || c || ']') else [question] end as parts from r)
    select id, cast(unnest(range(len(parts))) as integer) as part, unnest(parts) as sub_question from p""")
def qr_decompose(t: Tables) -> DataFrame:
    return routing.decompose(routing.route(routing.detect(_questions(t), _aliases(t))), _questions(t))


def _sql_words(words: list[str]) -> str:
    return entities.alternation(words).replace("'", "''")


@query(rf"""with {_CHUNKS_SQL}, e as (select chunk_id as id, 'METRIC' as type, lower(unnest(regexp_extract_all(text, '{_sql_words(entities.METRIC_TERMS)}', 1))) as text from chunk
    union all select chunk_id, 'RISK', lower(unnest(regexp_extract_all(text, '{_sql_words(entities.RISK_TERMS)}', 1))) from chunk
    union all select chunk_id, 'MONEY', unnest(regexp_extract_all(text, '(\$[0-9][0-9,]*(?:\.[0-9]+)?(?: (?:million|billion))?)', 1)) from chunk
    union all select chunk_id, 'DATE', unnest(regexp_extract_all(text, '\b((?:(?:{entities.MONTH}) [0-9]{{1,2}}, )?(?:19|20)[0-9]{{2}})\b', 1)) from chunk
    union all select * from (select chunk_id, 'CARDINAL', unnest(regexp_extract_all(text, '(?:^|[ (])([0-9][0-9,]*(?:\.[0-9]+)?) [a-z]', 1)) as x from chunk) where not regexp_matches(x, '^\d{{1,2}}$') and not regexp_matches(x, '^\d{{5}}$'))
    select type, text, count(*) as n, count(distinct id) as chunks from e group by 1, 2""")
def en_extract(t: Tables) -> DataFrame:
    found = entities.extract(_chunks(t).select("id", "text"))
    return found.groupBy("type", "text").agg(F.count("*").alias("n"), F.countDistinct("id").alias("chunks"))


@query()
def en_by_type(t: Tables) -> DataFrame:
    """(id, total, types): entities of each chunk by type."""
    found = entities.by_type(entities.extract(_chunks(t).select("id", "text")))
    return found.select("id", "total", F.map_keys("entities_by_type").alias("types"))
