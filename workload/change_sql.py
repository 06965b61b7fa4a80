"""DuckDB SQL for the queries of ``change_queries``."""

CHANGES = """changes as (
    select event_id as seq,
           case when event_id % 4001 = 3500 then 'drop_database'
                when event_id % 331 = 300 then 'drop'
                when event_type = 'signup' then 'insert'
                when event_type = 'error' then 'delete'
                else 'update' end as op,
           case when user_id % 8 >= 4 then 'db1' else 'db0' end as database,
           concat('c', cast(user_id % 4 as varchar)) as collection,
           lpad(cast(user_id * 8 + event_id % 8 as varchar), 24, '0') as uid,
           event_type, value, ts, props
    from events)"""
ALLOWED = """allowed as (
    select * from changes where collection in ('c0', 'c1', 'c2') or op = 'drop_database')"""
FIELDS = """event_type, value, strftime(ts, '%Y-%m-%d') as day, props"""
OUTPUT = f"""collection as index_name, uid as _id, collection as _collection, database as _database, {FIELDS}"""
DOCUMENT_OPS = ("insert", "update", "delete")


def listed(ops) -> str:
    return ", ".join(f"'{op}'" for op in ops)


def live(source: str, update: str = "replace", ops=DOCUMENT_OPS, drop: str | None = "database, collection",
         drop_database: str | None = "database", key: str = "database, collection, uid") -> str:
    """CTEs ending in ``live``: the rows of the latest image of every document that exists."""
    if update == "ignore":
        ops = [op for op in ops if op != "update"]
    anchor = "op = 'insert'" if update == "merge" else "op <> 'delete'"
    checks = []
    if drop:
        on = " and ".join(f"d.{c.strip()} = r.{c.strip()}" for c in drop.split(","))
        checks.append(f"not exists (select 1 from {source} d where d.op = 'drop' and {on} and d.seq > anchor_seq)")
    if drop_database:
        on = "d.database = r.database" if drop_database == "database" else "true"
        checks.append(
            f"not exists (select 1 from {source} d where d.op = 'drop_database' and {on} and d.seq > anchor_seq)")
    condition = " and ".join(["true", *checks])
    return f"""ranked as (
        select *, max(case when {anchor} then seq end) over k as anchor_seq,
               max(case when op = 'delete' then seq end) over k as delete_seq,
               max(case when op <> 'delete' then seq end) over k as image_seq
        from {source} where op in ({listed(ops)}) window k as (partition by {key})),
      live as (
        select * from ranked r
        where seq = image_seq and anchor_seq is not null and anchor_seq > coalesce(delete_seq, -1) and {condition})"""


def applied(select: str = OUTPUT, **options) -> str:
    return f"with {CHANGES}, {ALLOWED}, {live('allowed', **options)} select {select} from live"


NO_DROPS = {"drop": None, "drop_database": None}
HALF = "(select max(event_id) // 2 from events)"
SHARED = """shared as (select * replace (
    lpad(cast((cast(uid as bigint) // 64) * 8 + cast(uid as bigint) % 8 as varchar), 24, '0') as uid) from allowed)"""
BODY = """concat('{"_collection":"', collection, '","_database":"', database, '","event_type":"', event_type,
    '","value":', cast(value as varchar), ',"day":"', strftime(ts, '%Y-%m-%d'), '"}')"""
PLAIN_LIVE = "uid, collection, database, event_type, value, ts, props"
DOC_ID = "lpad(cast({} as varchar), 24, '0')"


def text_rows(doc_id: str, source: str, where: str) -> str:
    return f"""select lang as index_name, {DOC_ID.format(doc_id)} as _id, lang as _collection, 'corpus' as _database,
        {source} as source, n_chars, md5(text) as text_md5 from documents where {where}"""


def stale(where: str = "true") -> str:
    return text_rows("doc_id", "'old'", where) + " union all " + text_rows("doc_id + 10000000000", "'old'", where)


def reset_target(alias: str) -> str:
    """The last event at which an update's document was inserted, deleted or dropped."""
    return f"""(select arg_max(c.op, c.seq) from changes c where c.seq < {alias}.seq and (
        (c.op in ('insert', 'delete') and c.database = {alias}.database and c.collection = {alias}.collection
         and c.uid = {alias}.uid)
        or (c.op = 'drop' and c.database = {alias}.database and c.collection = {alias}.collection)
        or (c.op = 'drop_database' and c.database = {alias}.database)))"""


ORACLE_SQL = {
    "change_normalise": f"""with {CHANGES} select seq, op, database, collection,
        case when op not in ('drop', 'drop_database') then uid end as uid,
        case when op in ('insert', 'update') then event_type end as event_type,
        case when op in ('insert', 'update') then value end as value,
        case when op in ('insert', 'update') then props end as props from changes""",
    "allowlist_filter": f"with {CHANGES}, {ALLOWED} select seq, op, database, collection, uid from allowed",
    "cdc_upsert": applied(ops=["insert"], **NO_DROPS),
    "cdc_delete": applied(ops=["insert", "delete"], **NO_DROPS),
    "cdc_update_replace": applied(**NO_DROPS),
    "cdc_update_merge": applied(update="merge", **NO_DROPS),
    "cdc_update_ignore": applied(update="ignore", **NO_DROPS),
    "cdc_drop_collection": applied(drop_database=None),
    "cdc_drop_database": applied(drop=None),
    "cdc_full_replay": applied(),
    "cdc_merge_ext": f"""with {CHANGES}, {ALLOWED}, {live("allowed", update="merge")}
        select uid as _id, collection as _collection, database as _database, value,
          (select arg_max(r.props, r.seq) from ranked r where r.uid = l.uid and r.database = l.database
             and r.collection = l.collection and r.event_type = 'click' and r.op <> 'delete'
             and r.seq >= l.anchor_seq) as click,
          (select arg_max(r.props, r.seq) from ranked r where r.uid = l.uid and r.database = l.database
             and r.collection = l.collection and r.event_type = 'purchase' and r.op <> 'delete'
             and r.seq >= l.anchor_seq) as purchase
        from live l""",
    "cdc_index_key": f"""with {CHANGES}, {ALLOWED}, {SHARED}, {live("shared", key="uid")}
        select * replace ('shared' as index_name) from (select {OUTPUT} from live)""",
    "cdc_index_key_merge": f"""with {CHANGES}, {ALLOWED}, {SHARED},
        images as (select *, lead(seq) over (partition by uid order by seq) as next_seq
          from shared where op in ('insert', 'update')),
        keys as (select uid, max(case when op = 'insert' then seq end) as inserted,
            max(case when op = 'delete' then seq end) as deleted, max(case when op <> 'delete' then seq end) as last
          from shared where op in ('insert', 'update', 'delete') group by uid),
        cleared as (select i.uid from images i join keys k on i.uid = k.uid and i.seq >= k.inserted
          where exists (select 1 from shared d where d.seq > i.seq and d.seq < coalesce(i.next_seq, 1e18)
            and d.database = i.database
            and (d.op = 'drop_database' or (d.op = 'drop' and d.collection = i.collection)))),
        live as (select i.* from images i join keys k on i.uid = k.uid and i.seq = k.last
          where k.inserted > coalesce(k.deleted, -1) and i.uid not in (select uid from cleared))
        select * replace ('shared' as index_name) from (select {OUTPUT} from live)""",
    "change_extended_json": f"""select event_id as seq, {DOC_ID.format("event_id")} as uid,
        {DOC_ID.format("user_id")} as "user", event_id as number, value, strftime(ts, '%Y-%m-%d %H:%M:%S') as at,
        cast(7 as integer) as n, '{{"$oid": "kept"}}' as props from events""",
    "reject_unreadable": f"""with {CHANGES}, {ALLOWED}, usable as (select * from allowed
          where not (event_type = 'click' and op in ('insert', 'update', 'delete'))),
        {live("usable")} select {OUTPUT} from live""",
    "policy_embedded": applied(update="ignore", drop="collection", drop_database="all"),
    "policy_partial_update": applied(update="merge", drop="collection", drop_database=None, key="collection, uid"),
    "policy_full_replace": applied(drop_database=None, key="collection, uid"),
    "collection_size": applied("database, collection, count(*) as n") + " group by database, collection",
    "rejects": f"""with {CHANGES}, broken as (select seq,
            case when op = 'update' and event_type = 'purchase' then 'rename' else op end as op,
            case when event_type <> 'view' then uid end as uid from changes)
        select seq, op, case when op = 'rename' then 'unknown_op' else 'missing_key' end as reason
        from broken where op = 'rename' or (op in ('insert', 'update', 'delete') and uid is null)
        union all
        select seq, op, 'update_without_target' from changes u
        where op = 'update' and coalesce({reset_target("u")}, 'none') <> 'insert'""",
    "strict_types": f"""with {CHANGES}, {ALLOWED} select seq, 'type_mismatch' as reason from allowed
        where op in ('insert', 'update') and event_type = 'click'""",
    "clear_collection": stale("lang not in ('en', 'de')"),
    "reindex_collections": stale("lang not in ('en', 'de')") + " union all "
    + text_rows("doc_id", "source", "lang in ('en', 'de')"),
    "initial_backfill": text_rows("doc_id", "source", "true") + " union all "
    + text_rows("doc_id + 10000000000", "'old'", "true"),
    "reindex_two_databases": stale("lang not in ('en', 'de')") + " union all "
    + text_rows("doc_id", "source", "lang in ('en', 'de')")
    + f" union all select * replace ('other' as _database) from ({stale()})",
    "backfill_index_key": f"""with fresh as (select *, doc_id // 2 as id, concat('c', cast(doc_id % 2 as varchar)) as c
          from documents),
        kept as (select * from fresh qualify row_number() over (partition by id order by c desc) = 1)
        select 'shared' as index_name, {DOC_ID.format("id")} as _id, c as _collection, 'corpus' as _database,
          source, n_chars, md5(text) as text_md5 from kept
        union all
        select 'shared', {DOC_ID.format("doc_id")}, 'old', 'corpus', source, n_chars, md5(text) from documents
        where doc_id not in (select id from kept)""",
    "store_overlapping_append": applied(),
    "store_upsert_then_feed": applied() + f""" union all select 'c1', {DOC_ID.format("s_suppkey")}, 'c1', 'db2',
        'supplier', s_acctbal, '2024-02-03', s_name from supplier""",
    "store_late_rejects": f"""with {CHANGES}, {ALLOWED} select seq, op, 'late' as reason from allowed
        where seq <= {HALF}""",
    "late_fold": applied(),
    "stream_cdc_apply": applied(),
    "stream_restart": applied(),
    "stream_pause_reindex": f"""with {CHANGES}, {ALLOWED}, rebuilt as (
          select seq, op, {PLAIN_LIVE} from allowed where not (seq <= {HALF} and collection = 'c0')
            and not (op = 'drop_database' and seq <= {HALF})
          union all
          select seq, op, uid, c.collection, database, event_type, value, ts, props
          from allowed, (values ('c1'), ('c2')) c(collection) where op = 'drop_database' and seq <= {HALF}
          union all
          select {HALF} + 0.5, 'insert', uid, collection, database, 'snapshot', max(value), max(ts), max(props)
          from changes where collection = 'c0' and seq <= {HALF} and op in ('insert', 'update', 'delete')
          group by database, collection, uid),
        scoped as (select * replace (case when op = 'drop_database' and seq <= {HALF} then 'drop' else op end as op)
          from rebuilt),
        {live("scoped")} select {OUTPUT} from live""",
    "custom_action": applied() + " where value >= 10",
    "action_export": f"""with {CHANGES}, {ALLOWED}, early as (select * from allowed where seq <= {HALF}),
        old as (with {live("early")} select collection as index_name, uid, {BODY} as body from live),
        new as (with {live("allowed")} select collection as index_name, uid, {BODY} as body from live)
        select coalesce(o.index_name, n.index_name) as index_name, coalesce(o.uid, n.uid) as uid,
          case when o.uid is null then 'index' when n.uid is null then 'delete' else 'update' end as action, n.body
        from old o full join new n on o.index_name = n.index_name and o.uid = n.uid
        where o.body is distinct from n.body""",
    "action_sink": f"""with {CHANGES}, {ALLOWED}, early as (select * from allowed where seq <= {HALF}),
        old as (with {live("early")} select collection as index_name, uid, {BODY} as body from live),
        new as (with {live("allowed")} select collection as index_name, uid, {BODY} as body from live)
        select coalesce(o.index_name, n.index_name) as index_name, coalesce(o.uid, n.uid) as uid,
          case when o.uid is null then 'index' when n.uid is null then 'delete' else 'update' end as action, n.body
        from old o full join new n on o.index_name = n.index_name and o.uid = n.uid
        where o.body is distinct from n.body""",
    "stream_feed_source": applied(),
}
