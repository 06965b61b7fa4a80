"""DuckDB SQL for the queries of ``mapping_queries``."""

from workload.mapping_queries import ENGLISH_STOP_WORDS, GERMAN_STOP_WORDS

UID = "lpad(cast({} as varchar), 24, '0')"
DOC_ID = UID.format("doc_id")
ORDER_ID = UID.format("o_orderkey")
LINES = "string_split(text, chr(10))"
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
CLAUSES = f"flatten(list_transform({LINES}, lambda p: string_split(p, ',')))"
OPENINGS = f"list_filter(list_transform({LINES}, lambda p: string_split(p, ' ')[1]), lambda x: x <> '')"
SENTENCES = f"flatten(list_transform({LINES}, lambda p: list_filter(string_split(p, '.'), lambda s: s <> '')))"
NUMBERS = f"list_transform({LINES}, lambda p: nullif(regexp_extract(p, '[0-9]+'), ''))"
FOUND = f"list_filter({NUMBERS}, lambda x: x is not null)"


def join_md5(values: str, separator: str = "|") -> str:
    return f"md5(coalesce(array_to_string({values}, '{separator}'), ''))"


def orders(select: str) -> str:
    return f"""select {ORDER_ID} as _id, {select}
        from orders left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"""


def docs(select: str, where: str = "true") -> str:
    return f"select {DOC_ID} as _id, {select} from documents where {where}"


def quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


SEGMENT = "case when c_mktsegment <> 'BUILDING' then c_mktsegment end"
TYPED = f"(select doc_id, unnest({SENTENCES}) as s, generate_subscripts({SENTENCES}, 1) as i from documents)"

ORACLE_SQL = {
    "snapshot_scan": f"""select 'corpus' as database, lang as collection, {DOC_ID} as uid, source, n_chars,
        md5(text) as text_md5 from documents""",
    "source_counts": "select 'corpus' as database, lang as collection, count(*) as n from documents group by lang",
    "map_scalar": orders("o_orderstatus as status, o_orderpriority as prio, cast(null as varchar) as absent"),
    "map_variant_scalar": orders(f"""o_orderstatus as status, 'none' as absent, {SEGMENT} as segment, n_name as nation,
        strftime(o_orderdate, '%Y-%m-%d') as placed, cast(c_acctbal > 5000 as varchar) as vip,
        cast(left(o_orderpriority, 1) as integer) as rank, cast(round(o_totalprice * 100) as bigint) as cents,
        cast(o_totalprice as float) as weight, o_totalprice as total, cast(null as varchar) as no_text"""),
    "map_variant_list_deep": docs(f"""md5(text) as lines_md5, {join_md5(OPENINGS)} as openings_md5, {join_md5(CLAUSES)} as clauses_md5,
        cast(len({SENTENCES}) as bigint) as n, {join_md5(SENTENCES)} as bodies_md5,
        cast(list_max(list_transform({SENTENCES}, lambda s: length(s))) as integer) as max_size, source as origin,
        cast(0 as bigint) as n_missing,
        case when len({FOUND}) = 0 then md5('none') else {join_md5(FOUND)} end as numbers_md5"""),
    "strict_types_nested": f"""select {DOC_ID} as uid, 'type_mismatch' as reason from documents
        where len(list_filter({SENTENCES}, lambda s: length(s) >= 150 and not contains(s, chr(34)) and not contains(s, chr(92)))) > 0""",
    "map_embedded": orders(f"c_name as buyer, {SEGMENT} as segment, n_name as nation, r_name as region"),
    "map_null_default": orders("cast(null as varchar) as nothing, 'n/a' as note"),
    "map_date_format": orders("""strftime(o_orderdate, '%Y-%m-%d') as placed,
        strftime(o_orderdate, '%Y%m%dT%H%M%S') as placed_compact, strftime(o_orderdate, '%Y/%m') as placed_month"""),
    "map_boolean": orders("""cast(o_orderpriority like '1%' as varchar) as urgent,
        cast(c_acctbal > 5000 as varchar) as vip"""),
    "map_numeric": orders("""cast(left(o_orderpriority, 1) as integer) as rank,
        cast(round(o_totalprice * 100) as bigint) as cents, cast(o_totalprice as float) as weight,
        o_totalprice as total"""),
    "map_default": orders(f"coalesce({SEGMENT}, 'none') as segment, cast(7 as integer) as rank"),
    "map_default_list": docs(f"""cast(greatest(len({FOUND}), 1) as bigint) as n,
        case when len({FOUND}) = 0 then md5('none') else {join_md5(FOUND)} end as numbers_md5"""),
    "map_list": docs(f"cast(len({LINES}) as bigint) as n, md5(text) as lines_md5"),
    "map_list_path": docs(f"""cast(len({OPENINGS}) as bigint) as n_openings, {join_md5(OPENINGS)} as openings_md5,
        cast(len({CLAUSES}) as bigint) as n_clauses, {join_md5(CLAUSES)} as clauses_md5"""),
    "map_list_path_deep": docs(f"cast(len({SENTENCES}) as bigint) as n, {join_md5(SENTENCES)} as bodies_md5"),
    "map_list_wrap": docs("cast(1 as bigint) as n, source as origin, cast(0 as bigint) as n_missing"),
    "map_list_typed": f"""
        with s as {TYPED}, a as (
          select doc_id, max(length(s)) as hi, min(length(s)) as lo,
                 string_agg(cast(length(s) as varchar), '|' order by i) as longs,
                 string_agg(case when length(s) > 80 then 'true' else 'false' end, '|' order by i) as flags,
                 string_agg(strftime(date '1970-01-01' + cast(length(s) as integer), '%Y-%m-%d'), '|' order by i) as days
          from s group by doc_id)
        select {UID.format("d.doc_id")} as _id, cast(hi as integer) as max_int, cast(lo as bigint) as min_long,
               cast(hi / 2.0 as float) as max_float, cast(lo / 2.0 as double) as min_double,
               md5(coalesce(longs, '')) as longs_md5, md5(coalesce(flags, '')) as flags_md5,
               md5(coalesce(days, '')) as days_md5
        from documents d left join a on a.doc_id = d.doc_id""",
    "map_list_nulls": docs(f"'drop' as nulls, cast(len({FOUND}) as bigint) as n, {join_md5(FOUND)} as numbers_md5")
    + " union all " + docs(f"'keep' as nulls, cast(len({LINES}) as bigint) as n, {join_md5(FOUND)} as numbers_md5"),
    "map_custom": docs(f"upper(source) as source, md5(concat({LINES}[1], '|', {LINES}[-1])) as ends_md5"),
    "map_combine_append": docs(f"""cast(len({FOUND}) + 1 as bigint) as n,
        {join_md5(f"list_append({FOUND}, source)")} as names_md5"""),
    "map_combine_last": docs("source as names"),
    "project_rules": f"""select lang as index_name, {DOC_ID} as _id, lang as _collection, 'corpus' as _database,
        case when lang in ('de', 'en') then source when lang = 'es' then lang end as source,
        case when lang <> 'fr' then n_chars end as n_chars,
        case when lang in ('de', 'en') then md5(text) end as text_md5 from documents""",
    "route_index": f"""select case when lang in ('es', 'fr') then 'romance' else concat('corpus_', lang) end as index_name,
        lang as _collection, count(*) as n, max({DOC_ID}) as last_id from documents group by all""",
    "extender_tags": docs("""concat(lang, '|', source) as tags,
        case when n_chars > 2000 then 'yes' end as "long" """),
    "analyze_text": docs(f"cast(len({TOKENS}) as bigint) as n, {join_md5(TOKENS, ' ')} as tokens_md5"),
    "analyze_keyword": docs("cast(1 as bigint) as n, source as token"),
    "analyze_per_index": f"""
        with t as (select doc_id, case
            when lang = 'de' then list_filter({TOKENS}, lambda w: w not in ({quoted(GERMAN_STOP_WORDS)}))
            when lang = 'en' then list_filter({TOKENS}, lambda w: w not in ({quoted(ENGLISH_STOP_WORDS)}))
            else {TOKENS} end as w from documents)
        select {DOC_ID} as _id, cast(len(w) as bigint) as n, {join_md5("w", " ")} as tokens_md5 from t""",
    "stored_view": f"""select lang as index_name, {DOC_ID} as _id, lang as _collection, 'corpus' as _database,
        source, n_chars from documents""",
    "term_query": docs("lang as _collection, source", f"list_contains({TOKENS}, 'la')"),
    "bool_must_query": docs("source, n_chars", f"lang = 'fr' and source = 'src4' and list_contains({TOKENS}, 'le')"),
    "match_query": docs("lang as _collection", f"list_has_any({TOKENS}, ['der', 'tion', 'pour', 'the'])"),
    "numeric_range": docs("lang as _collection, n_chars", "n_chars between 500 and 5000"),
    "index_counts": "select lang as index_name, count(*) as n from documents group by lang",
    "get_by_id": docs("lang as _collection, source, n_chars", "doc_id in (select doc_id from labels)"),
    "facet_rows": f"""
        select lang as index_name, {DOC_ID} as _id, 'source' as dim, source as "value" from documents where lang <> 'fr'
        union all
        select lang, {DOC_ID}, 'openings', unnest(list_distinct({OPENINGS})) from documents where lang in ('en', 'fr')""",
    "facet_counts": f"""
        with f as (
          select doc_id, 'source' as dim, source as v from documents where lang <> 'fr'
          union all
          select doc_id, 'openings', unnest({OPENINGS}) from documents where lang in ('en', 'fr'))
        select dim, v as "value", count(distinct doc_id) as n from f group by dim, v""",
    "facet_counts_filtered": f"""
        with h as (select * from documents where lang = 'en' and list_contains({TOKENS}, 'the'))
        select 'source' as dim, source as "value", count(*) as n from h group by source
        union all select '_collection', lang, count(*) from h group by lang""",
    "term_postings": f"""
        with w as (select doc_id, unnest({TOKENS}) as term from documents)
        select term, {DOC_ID} as _id, count(*) as tf from w group by term, doc_id""",
    "index_table_roundtrip": f"""select lang as index_name, {DOC_ID} as _id, lang as _collection,
        'corpus' as _database, source, n_chars, md5(text) as text_md5 from documents""",
    "catalog_table_roundtrip": f"""select lang as index_name, {DOC_ID} as _id, lang as _collection,
        'corpus' as _database, source, n_chars, md5(text) as text_md5 from documents""",
    "term_query_stored": docs("lang as _collection, source", f"list_contains({TOKENS}, 'la')"),
    "reindex_incremental": "select 'insert' as kind, " + docs("lang as _collection, source", "doc_id % 100 in (7, 8)").removeprefix("select ")
    + " union all select 'delete', " + docs("lang, null", "doc_id % 100 = 9").removeprefix("select ")
    + " union all select 'document', " + docs("lang, source", "doc_id % 100 <> 9").removeprefix("select "),
    "reindex_metrics": """select lang as collection, count(*) as n_read, count(*) filter (where doc_id % 17 <> 0) as n_indexed,
        count(*) filter (where doc_id % 17 = 0) as n_rejected from documents where lang in ('en', 'de') group by lang""",
    "term_query_index": docs("lang as _collection", f"doc_id % 11 <> 5 and list_contains({TOKENS}, 'la')"),
    "match_query_index": docs("lang as _collection", f"doc_id % 11 <> 5 and list_has_any({TOKENS}, ['der', 'tion', 'pour', 'the'])"),
    "term_postings_index": f"""
        with w as (select doc_id, unnest({TOKENS}) as term from documents where doc_id % 11 <> 5)
        select term, {DOC_ID} as _id, count(*) as tf from w group by term, doc_id""",
    "facet_counts_index": """
        with h as (select * from documents where doc_id % 11 <> 5)
        select 'source' as dim, source as "value", count(*) as n from h group by source
        union all select '_collection', lang, count(*) from h group by lang""",
    "collection_size_maintained": """
        select 'corpus' as _database, lang as _collection, count(*) as n from documents
        where doc_id % 11 <> 5 and lang <> 'fr' group by lang""",
    "facet_counts_maintained": """
        with h as (select * from documents where doc_id % 11 <> 5 and lang <> 'fr')
        select 'source' as dim, source as "value", count(*) as n from h group by source
        union all select '_collection', lang, count(*) from h group by lang""",
    "facet_counts_filtered_index": f"""
        with h as (select * from documents where doc_id % 11 <> 5 and lang = 'en' and list_contains({TOKENS}, 'the'))
        select 'source' as dim, source as "value", count(*) as n from h group by source
        union all select '_collection', lang, count(*) from h group by lang""",
    "match_per_index": docs("lang as _collection", f"""case when lang = 'en'
        then list_has_any(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), ['The', 'LA'])
        else list_has_any({TOKENS}, ['the', 'la']) end"""),
    "keyword_per_collection": docs("lang as _collection, source",
                                   f"(lang <> 'de' and list_contains({TOKENS}, 'die')) or source = 'src4'"),
    "stored_per_collection": f"""select lang as index_name, {DOC_ID} as _id, lang as _collection, 'corpus' as _database,
        case when lang <> 'en' then source end as source, case when lang in ('es', 'fr') then n_chars end as n_chars
        from documents""",
}
