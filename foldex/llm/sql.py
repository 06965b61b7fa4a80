"""The registered queries' SQL for DuckDB, where SQL can express them."""

LINE_DEDUP = r"""
with lines as (
    select doc_id, generate_subscripts(parts, 1) as pos, unnest(parts) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
    from lines
), known as (
    select line_key, max(doc_id) as keeper from keyed where length(line_key) >= 40
    group by line_key having count(distinct doc_id) >= 5
), marked as (
    select k.*, known.keeper is not null and known.keeper <> k.doc_id as gone
    from keyed k left join known on k.line_key = known.line_key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

MIXING = r"""
with sizes as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
           strlen(coalesce(text, '')) as n_bytes,
           strlen(coalesce(text, '')) - strlen(regexp_replace(coalesce(text, ''), '[A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) as n_letters,
           (('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 12))::bigint + 0.5) / power(2, 48) as u
    from documents
), keyed as (
    select *, -ln(u) / (0.25 + 0.75 * coalesce(n_letters / nullif(n_bytes, 0), 0)) as k from sizes
), sources as (
    select source, sum(size) as source_size,
           1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
    from sizes group by source
), levels as (
    select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (
                   order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by 3 * source_size / weight, source nulls last
                                  rows between current row and unbounded following) as level
    from sources
), targets as (
    select source, source_size, least(3.0 * source_size, weight * max(level) over ()) as target from levels
), run as (
    select k.doc_id, k.size, t.source_size, t.target,
           coalesce(sum(k.size) over (partition by k.source order by k, doc_id
                                      rows between unbounded preceding and 1 preceding), 0) as before
    from keyed k join targets t on k.source is not distinct from t.source
), epochs as (
    select *, coalesce(floor(target / nullif(source_size, 0)), 0) as n from run
)
select doc_id, size, cast(source_size as bigint) as source_size, cast(target as double) as target,
       cast(size * (n + case when size > 0 and before + size / 2 <= target - n * source_size then 1 else 0 end) as bigint) as taken
from epochs
"""

WARC = r"""
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
), firsts as (
    select payload, max(page_id) as response from payloads group by payload
)
select p.page_id, strlen(p.payload) as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + cast((('0x' || substr(hex, cast(1 + 5 * (i // 4) as int), 5))::bigint >> (15 - 5 * (i % 4))) & 31 as int), 1)),
           'string_agg', '') as payload_digest,
       case when p.page_id = f.response then 'response' else 'revisit' end as record_type,
       case when p.page_id <> f.response then f.response end as refers_to
from payloads p join firsts f on p.payload = f.payload
"""

EXACT_DEDUP = r"""
with bodies as (
    select doc_id, length(coalesce(text, '')) as points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
    from documents
)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by body) as group_size,
       doc_id = first_value(doc_id) over best as kept, sha256(body) as text_sha256
from bodies window best as (partition by body order by points desc, doc_id)
"""

PHRASES = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
    select lang, sum(len(w)) as n from words group by lang
), counts as (
    select lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') as phrase, count(*) as f
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from words, (select unnest([1, 2, 3, 4]) as size))
    group by all having count(*) >= 30
), candidates as (
    select lang, phrase, size, string_split(phrase, ' ') as w, f as a from counts where size > 1
), kept as (
    select * from candidates c where not exists (
        select 1 from candidates o where o.lang = c.lang and o.size > c.size
        and contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') and 100 * o.a >= 80 * c.a)
), cuts as (
    select lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') as head, array_to_string(list_slice(w, k + 1, size), ' ') as tail
    from (select *, unnest(range(1, size)) as k from kept)
), scored as (
    select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r, cast((2000000::hugeint * c.a) // (h.f + t.f) as bigint) as score
    from cuts c join counts h on h.lang = c.lang and h.phrase = c.head join counts t on t.lang = c.lang and t.phrase = c.tail
), best as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       cast(n as bigint) as n, score
from best b join totals t on b.lang = t.lang
qualify row_number() over (partition by b.lang order by score desc, a desc, phrase) <= 2000
"""

CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(3 * length('<|endoftext|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) as bigint) as formatted_chars
from turns group by conv_id
"""

DIVERGENCE = r"""
with texts as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
), words as (
    select lang, source, d, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from texts
), kept as (
    select lang, term, count(*) as total from words group by all having count(distinct d) >= 3
), counts as (
    select w.lang, w.source, w.term, count(*) as n from words w join kept k on w.lang = k.lang and w.term = k.term group by all
), sizes as (
    select lang, count(*) as v, sum(total) as n from kept group by lang
), groups as (
    select g.lang, g.source, coalesce(s.v, 0) as v, coalesce(c.n, 0) as n, coalesce(s.n, 0) as lang_n
    from (select distinct lang, source from texts) g left join sizes s on s.lang = g.lang
    left join (select lang, source, sum(n) as n from counts group by all) c on c.lang = g.lang and c.source = g.source
), ps as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as own,
           1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + g.v) as p,
           1 + (1000000000::hugeint * (k.total + 1)) // (g.lang_n + g.v) as q
    from groups g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), pairs as (
    select a.lang, a.source, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join (select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p) as value
               from ps x join ps y on x.lang = y.lang and x.term = y.term group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source
), terms as (
    select lang, source, term as item, cast((p - q) * (p - q) // q as bigint) as value from ps where own > 0 and p > q
), parts as (
    select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term', item, value from terms
)
select lang, source, part, item, value, cast(row_number() over w as int) as rank from parts
window w as (partition by lang, source, part order by value desc, item)
qualify part = 'pair' or row_number() over w <= 200
"""

ORACLE_SQL = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_source_mixing": MIXING,
    "op6_warc": WARC,
    "op7_exact_dedup": EXACT_DEDUP,
    "op11_phrases": PHRASES,
    "op12_chat": CHAT,
    "op13_divergence": DIVERGENCE,
}
