"""SQL for the queries of this subpackage that SQL can express."""

ORACLES: dict[str, str] = {
    "p3_found": r"""
        with texts as (
            select 'section' as kind, cast(id as varchar) as item_key, markdown as body from filing_sections
            union all
            select 'chunk', chunk_id, text from chunks
        ), sizes as (
            select kind, item_key, len(regexp_extract_all(body, '[^ \t\r\n]+')) as words from texts where item_key is not null
        )
        select distinct kind, item_key, config_name
        from sizes, chunk_configs
        where floor(words * tokens_per_word) > max_tokens""",
    "p3_cover": r"""
        with texts as (
            select 'section' as kind, cast(id as varchar) as item_key, markdown as body from filing_sections
            union all
            select 'chunk', chunk_id, text from chunks
        ), sizes as (
            select distinct kind, item_key, md5(body) as digest, len(regexp_extract_all(body, '[^ \t\r\n]+')) as words from texts where item_key is not null and body is not null
        )
        select kind, item_key, digest, config_name, cast(words as bigint) as words, cast(0 as bigint) as over, cast(0 as bigint) as torn,
            cast((select max(n) from range(1, 10000) t(n) where floor(n * tokens_per_word) <= overlap_tokens) as bigint) as overlap
        from sizes, chunk_configs where floor(words * tokens_per_word) > max_tokens""",
    "p3_files": r"""
        select config_name, cast(sum(len(regexp_extract_all(markdown, '[^ \t\r\n]+'))) as bigint) as words, cast(0 as bigint) as over, cast(0 as bigint) as torn
        from filing_sections, chunk_configs group by 1""",
    "p4_found": r"""
        with usable as (
            select chunk_id, any_value(embedding)::double[] as v from chunks
            where chunk_id is not null and len(embedding) = 64 and list_dot_product(embedding::double[], embedding::double[]) > 0 group by 1
        ), unit as (
            select chunk_id, v, sqrt(list_dot_product(v, v)) as norm from usable
        ), ranked as (
            select a.chunk_id as a, b.chunk_id as b, row_number() over (partition by a.chunk_id order by list_dot_product(a.v, b.v) / (a.norm * b.norm) desc, b.chunk_id) as place
            from unit a join unit b on a.chunk_id <> b.chunk_id
        )
        select distinct least(a, b) as chunk_a, greatest(a, b) as chunk_b from ranked where place <= 5""",
    "p5_found": r"""
        with texts as (
            select 'section' as kind, cast(id as varchar) as item_key, markdown as body from filing_sections
            union all
            select 'chunk', chunk_id, text from chunks
        ), words as (
            select distinct kind, item_key, regexp_extract_all(lower(regexp_replace(body, '<[^>]*>', '', 'g')), '[a-z0-9]+') as w from texts where item_key is not null and body is not null
        ), long as (
            select row_number() over () as n, * from words where len(w) >= 30
        ), shingles as (
            select distinct n, kind, item_key, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from (select *, unnest(range(1, len(w) - 1)) as i from long)
        ), sizes as (
            select n, count(*) as size from shingles group by 1
        ), shared as (
            select a.n as p, b.n as q, a.kind, a.item_key as x, b.item_key as y, count(*) as common
            from shingles a join shingles b on a.s = b.s and a.kind = b.kind and a.item_key < b.item_key group by all
        )
        select distinct kind, x as key_a, y as key_b from shared join sizes s on s.n = p join sizes t on t.n = q
        where common >= 0.6::double * (s.size + t.size - common)""",
    "p6_check": """
        select spec_name, (select count(distinct doc_id) from documents) as texts, cast(0 as bigint) as over, cast(0 as bigint) as cut, cast(0 as bigint) as torn from pack_specs""",
}
