"""Equivalent SQL (DuckDB dialect) of every catalogue query that SQL can
express, over the driver's pre-registered tables. Written independently of the
Spark code: the ordered ingest is replayed by a sequential ``list_reduce``
fold, everything else by plain SQL.
"""

from __future__ import annotations

from . import catalog as C

_TEXT_D = "coalesce(nullif(text, ''), '')"
_TEXT_E = "coalesce(nullif(event_type || props, ''), '')"

D = f"""d as (
  select coalesce(source, '') as channel_id,
         coalesce(cast(doc_id as varchar), '') as message_id,
         coalesce(nullif(source, ''), '') as channel_name,
         {_TEXT_D} as text,
         timestamp '{C.FIXTURE_INGEST_TIME}' as date,
         doc_id as seq,
         sha256(trim(lower({_TEXT_D}))) as content_hash
  from documents)"""

E = f"""e as (
  select coalesce(event_type, '') as channel_id,
         coalesce(cast(user_id as varchar), '') as message_id,
         coalesce(nullif(event_type, ''), '') as channel_name,
         {_TEXT_E} as text,
         ts as date,
         event_id as seq,
         sha256(trim(lower({_TEXT_E}))) as content_hash
  from events)"""

CONV_FULL = """c as (
  select coalesce(role, '') as channel_id,
         concat_ws('/', conv_id, turn) as message_id,
         conv_id, turn,
         sha256(trim(lower(coalesce(nullif(text, ''), '')))) as content_hash
  from conversations)"""

CONV = """c as (
  select coalesce(role, '') as channel_id,
         concat_ws('/', conv_id, turn) as message_id,
         sha256(trim(lower(coalesce(nullif(text, ''), '')))) as content_hash
  from conversations)"""

# Sequential fold over E in event_id order: keep a row iff neither its ID key
# nor its hash was kept before.
def fold(src: str, p: str = "") -> str:
    """CTEs ``{p}kept_o`` / ``{p}kept``: the kept rows of the fold over ``src``."""
    return f"""{p}ek as (
  select list({{'o': [seq], 'a': [channel_id || chr(31) || message_id], 'b': [content_hash]}}
              order by seq) as l
  from {src}),
{p}kept_o as (
  select unnest(list_reduce(l, lambda acc, x:
           case when list_contains(acc.a, x.a[1]) or list_contains(acc.b, x.b[1]) then acc
                else {{'o': acc.o || x.o, 'a': acc.a || x.a, 'b': acc.b || x.b}} end).o) as o
  from {p}ek),
{p}kept as (select {src}.* from {src} join {p}kept_o on {src}.seq = {p}kept_o.o)"""


E_FOLD = fold("e") + """,
es as (
  select e.*,
         case when e.seq in (select o from kept_o) then 'new'
              when exists (select 1 from kept k where k.channel_id = e.channel_id
                             and k.message_id = e.message_id and k.seq < e.seq) then 'dup_id'
              else 'dup_content' end as status
  from e)"""

# Documents: IDs are unique, so only the first row per hash is new.
D_FIRST = """ds as (
  select d.*, case when row_number() over (partition by content_hash order by seq) = 1
                   then 'new' else 'dup_content' end as status
  from d)"""

LABELLED = "st as (select * from d where seq in (select doc_id from labels))"


def _reason(status: str = "status") -> str:
    return (f"case {status} when 'dup_id' then 'Message ID ' || message_id || "
            f"' already processed for channel ' || channel_id "
            f"when 'dup_content' then 'Identical content already processed (hash: ' || "
            f"left(content_hash, 8) || '...)' else 'No duplicate detected' end")


def _rate(dup: str, total: str) -> str:
    return (f"round(case when {total} > 0 then cast({dup} as double) / {total} * 100.0 "
            f"else 0.0 end, 6)")


def _rate_text(dup: str, total: str) -> str:
    # exact: tenths of a percent in whole numbers would round 3/2000 up, the
    # nearest double lies below 0.15; printf rounds the double's exact value
    return (f"case when {total} > 0 then printf('%.1f%%', cast({dup} as double) / {total} "
            f"* 100.0) else '0%' end")


def _values(rows: list[tuple]) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return "values " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _event_channels() -> str:
    rows = [(i, c) for i, c in enumerate(C.EVENT_CHANNELS.split(","))]
    return f"chl(channel_ordinal, channel) as ({_values(rows)})"


def _stats_select(src: str) -> str:
    return f"""select channel_id, count(*) as total_messages,
         count(*) filter (where status = 'new') as new_messages,
         count(*) filter (where status <> 'new') as duplicates
  from {src} group by channel_id"""


def _with_rates(src: str, extra: str = "") -> str:
    return f"""select {extra}channel_id, total_messages, new_messages, duplicates,
       {_rate('duplicates', 'total_messages')} as duplicate_rate,
       {_rate_text('duplicates', 'total_messages')} as duplicate_rate_text
  from {src}"""


def _ts(text: str) -> str:
    return f"timestamp '{text}'"


def _gap(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier})) / 1000000.0"


_AS_OF_MINUS = {
    "recent": f"({_ts(C.AS_OF)} - interval {C.RECENT_DAYS} day)",
    "retention": f"({_ts(C.AS_OF)} - interval {C.RETENTION_DAYS} day)",
}

_ISO = ("case when epoch_us({c}) % 1000000 = 0 then strftime({c}, '%Y-%m-%dT%H:%M:%S') "
        "else strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') end")

# The fixed values of the routing, written out here a second time so that the
# oracle does not depend on the code under test.
_TASKS = [("summary", "llama3.1:8b"), ("analysis", "deepseek-r1:32b"), ("quick", "phi3:mini"),
          ("code", "codellama:34b"), ("complex", "deepseek-r1:32b"), ("default", "llama3.1:8b")]
_OTHER_TASK = "llama3.1:8b"
_REMOTE, _REMOTE_ABOVE = "claude-3-sonnet-20240229", 2000

_D_CHANNELS = """o as (
  select d.*, cast(dense_rank() over (order by channel_id) - 1 as integer) as channel_ordinal from d)"""

V = """v as (
  select coalesce(event_type, '') as channel_id, coalesce(cast(user_id as varchar), '') as message_id,
         event_id as seq, sha256(trim(lower(coalesce(cast(value as varchar), '')))) as content_hash
  from events)"""

U = """u as (
  select 'events' as channel_id, coalesce(cast(user_id as varchar), '') as message_id,
         event_id as seq, sha256(coalesce(cast(cast(trunc(value) as bigint) as varchar), '')) as content_hash
  from events)"""


def _folded(src: str) -> str:
    """Statuses of ``src`` from its fold."""
    return f"""select seq as event_id,
       case when seq in (select o from kept_o) then 'new'
            when exists (select 1 from kept k where k.channel_id = {src}.channel_id
                           and k.message_id = {src}.message_id and k.seq < {src}.seq) then 'dup_id'
            else 'dup_content' end as status
from {src}"""


ORACLE_SQL: dict[str, str] = {
    "normalize_messages": f"""with {D}
select channel_id, message_id, channel_name, text, date, seq from d""",

    "content_fingerprint": f"""with {D}, {CONV}
select 'documents' as feed, channel_id, message_id, content_hash,
       left(content_hash, 8) as hash_prefix from d
union all
select 'conversations' as feed, channel_id, message_id, content_hash,
       left(content_hash, 8) as hash_prefix from c""",

    "tracking_rows": f"""with {E}
select message_id, channel_id, channel_name, {_ISO.format(c='date')} as date, content_hash,
       '{C.PROCESSED_AT.replace(' ', 'T')}' as processed_at, 'completed' as processing_status,
       0 as ai_processed, cast(null as varchar) as storage_path
from e""",

    "distinct_ids": f"""with {E} select distinct channel_id, message_id from e""",

    "distinct_hashes": f"""with {D}
select distinct content_hash from d where content_hash is not null and content_hash <> ''""",

    "id_members": f"""with {D}, {LABELLED}
select seq as doc_id, channel_id, message_id from d
where exists (select 1 from st where st.channel_id = d.channel_id
              and st.message_id = d.message_id)""",

    "content_members": f"""with {D}, {LABELLED}
select seq as doc_id, channel_id, message_id from d
where exists (select 1 from st where st.content_hash = d.content_hash)""",

    "classify_against_state": f"""with {D}, {LABELLED},
cl as (
  select d.*, case when exists (select 1 from st where st.channel_id = d.channel_id
                                  and st.message_id = d.message_id) then 'dup_id'
                   when exists (select 1 from st where st.content_hash = d.content_hash)
                        then 'dup_content'
                   else 'new' end as status
  from d)
select seq as doc_id, status, status <> 'new' as is_duplicate, {_reason()} as reason from cl""",

    "filter_against_state": f"""with {D}, {LABELLED}
select seq as doc_id, channel_id, message_id from d
where not exists (select 1 from st where st.channel_id = d.channel_id
                  and st.message_id = d.message_id)
  and not exists (select 1 from st where st.content_hash = d.content_hash)""",

    "check_counters": f"""with {D}, {LABELLED},
cl as (
  select exists (select 1 from st where st.channel_id = d.channel_id
                   and st.message_id = d.message_id)
      or exists (select 1 from st where st.content_hash = d.content_hash) as dup
  from d)
select count(*) as messages_checked, count(*) filter (where dup) as duplicates_detected,
       count(*) filter (where dup) as cache_hits
from cl""",

    "ingest_status": f"""with {E}, {E_FOLD}
select seq as event_id, channel_id, message_id, status, {_reason()} as reason from es""",

    "ingest_documents": f"""with {D}, {D_FIRST}
select seq as doc_id, status, {_reason()} as reason from ds""",

    "ingest_by_channel": f"""with {D}, {_D_CHANNELS}
select channel_ordinal, seq as doc_id,
       case when row_number() over (partition by content_hash
                                    order by channel_ordinal, seq) = 1
            then 'new' else 'dup_content' end as status
from o""",

    "ingest_with_state": f"""with {E}, {E_FOLD}
select seq as event_id, status from es where date >= {_ts(C.SPLIT_TS)}""",

    "id_only_dedup": f"""with {E}
select seq as event_id,
       case when row_number() over (partition by channel_id, message_id order by seq) = 1
            then 'new' else 'dup_id' end as status
from e""",

    "content_only_dedup": f"""with {E}
select seq as event_id,
       case when row_number() over (partition by content_hash order by seq) = 1
            then 'new' else 'dup_content' end as status
from e""",

    "channel_stats": f"""with {E}, {E_FOLD}, {D}, {D_FIRST},
ge as ({_stats_select('es')}),
je as (select cast(row_number() over (order by channel_id) - 1 as integer) as channel_ordinal, * from ge),
gd as ({_stats_select('ds')})
select *, 'events' as feed from ({_with_rates('je', 'channel_ordinal, ')})
union all
select *, 'documents' as feed from ({_with_rates('gd', 'cast(null as integer) as channel_ordinal, ')})""",

    "run_totals": f"""with {E}, {E_FOLD},
g as ({_stats_select('es')}),
t as (
  select count(*) as channels_processed,
         cast(coalesce(sum(total_messages), 0) as bigint) as total_messages,
         cast(coalesce(sum(new_messages), 0) as bigint) as new_messages,
         cast(coalesce(sum(duplicates), 0) as bigint) as duplicates
  from g)
select channels_processed, total_messages, new_messages, duplicates,
       {_rate('duplicates', 'total_messages')} as duplicate_rate,
       {_rate_text('duplicates', 'total_messages')} as duplicate_rate_text
from t""",

    "duplicates_by_reason": f"""with {E}, {E_FOLD}
select channel_id, status, count(*) as messages from es group by rollup (channel_id, status)""",

    "tracker_statistics": f"""with {E}, {E_FOLD}
select count(distinct channel_id) as channels_tracked,
       count(distinct [channel_id, message_id]) as total_messages_tracked,
       count(distinct nullif(content_hash, '')) as content_hashes,
       count(distinct [channel_id, message_id]) as total_in_db,
       '2.0.0' as version
from kept""",

    "ids_per_channel": f"""with {E}, {E_FOLD}
select channel_id, count(distinct message_id) as n_ids, min(message_id) as first_id,
       max(message_id) as last_id
from kept group by channel_id""",

    "channel_throughput": f"""with {E}, {E_FOLD},
g as (
  select channel_id, count(*) filter (where status = 'new') as new_messages,
         {_gap('max(date)', 'min(date)')} as elapsed
  from es group by channel_id)
select channel_id, new_messages, round(elapsed, 2) as elapsed_seconds,
       printf('%.2fs', elapsed) as elapsed_text,
       round(case when elapsed > 0 then cast(new_messages as double) / elapsed else 0.0 end, 6)
         as messages_per_second
from g""",

    "cumulative_daily": f"""with {E}, {E_FOLD},
g as (
  select channel_id, cast(date as date) as day, count(*) as messages,
         count(*) filter (where status = 'new') as new_messages,
         count(*) filter (where status <> 'new') as duplicates
  from es group by channel_id, cast(date as date))
select channel_id, day, messages, new_messages, duplicates,
       cast(sum(messages) over w as bigint) as cum_messages,
       cast(sum(new_messages) over w as bigint) as cum_new_messages,
       cast(sum(duplicates) over w as bigint) as cum_duplicates
from g
window w as (partition by channel_id order by day rows between unbounded preceding
             and current row)""",

    "latest_per_key": f"""with {E}
select channel_id, message_id, seq as event_id, content_hash from (
  select e.*, row_number() over (partition by channel_id, message_id
                                 order by date desc, seq desc) as rn
  from e) where rn = 1""",

    "latest_n_per_channel": f"""with {E}
select channel_id, event_id, position from (
  select channel_id, seq as event_id,
         row_number() over (partition by channel_id order by date desc, seq desc) as position
  from e) where position <= {C.LIMIT_PER_CHANNEL}""",

    "recent_messages": f"""with {E}
select seq as event_id, channel_id, message_id from e
where date is null or date >= {_AS_OF_MINUS['recent']}""",

    "message_batches": f"""with {E},
r as (select seq, channel_id,
             row_number() over (partition by channel_id order by seq) as position from e)
select seq as event_id, channel_id, position,
       cast((position - 1) // {C.BATCH_SIZE} as bigint) as batch_number
from r""",

    "high_water_mark": f"""with {E}
select channel_id, message_id as last_message_id, seq as mark_event_id from (
  select e.*, row_number() over (partition by channel_id order by date desc, seq desc) as rn
  from e) where rn = 1""",

    "after_mark": f"""with {E},
m as (
  select channel_id, date as mdate, seq as mseq from (
    select e.*, row_number() over (partition by channel_id order by date desc, seq desc) rn
    from e where date < {_ts(C.SPLIT_TS)}) where rn = 1)
select e.seq as event_id, e.channel_id from e left join m on e.channel_id = m.channel_id
where m.mseq is null or e.date > m.mdate or (e.date = m.mdate and e.seq > m.mseq)""",

    "retained_rows": f"""with {E}
select seq as event_id, channel_id, message_id from e where date >= {_AS_OF_MINUS['retention']}""",

    "rapid_reposts": f"""with {E},
l as (select e.*, lag(date) over (partition by channel_id, content_hash
                                  order by date, seq) as prev_date from e)
select seq as event_id, channel_id, round({_gap('date', 'prev_date')}, 6) as gap_seconds,
       coalesce({_gap('date', 'prev_date')} <= {C.REPOST_SECONDS}, false) as is_repost
from l""",

    "burst_ids": f"""with {E},
l as (select e.*, lag(date) over (partition by channel_id order by date, seq) as prev_date
      from e),
s as (select l.*, case when prev_date is null
                         or {_gap('date', 'prev_date')} > {C.BURST_GAP_SECONDS}
                       then 1 else 0 end as st from l)
select seq as event_id, channel_id,
       cast(sum(st) over (partition by channel_id order by date, seq
                          rows between unbounded preceding and current row) as bigint)
         as burst_id
from s""",

    "burst_summary": f"""with {E},
l as (select e.*, lag(date) over (partition by channel_id order by date, seq) as prev_date
      from e),
s as (select l.*, case when prev_date is null
                         or {_gap('date', 'prev_date')} > {C.BURST_GAP_SECONDS}
                       then 1 else 0 end as st from l),
b as (select s.*, cast(sum(st) over (partition by channel_id order by date, seq
                                     rows between unbounded preceding and current row)
                       as bigint) as burst_id from s)
select channel_id, burst_id, min(date) as burst_start, max(date) as burst_end,
       count(*) as messages, count(distinct content_hash) as distinct_texts
from b group by channel_id, burst_id""",

    "model_for_task": f"""with tr(task, model) as ({_values(_TASKS)}),
t as (select distinct task from (
        select event_type as task from events
        union all select task from tr union all select 'translate'))
select t.task, coalesce(tr.model, '{_OTHER_TASK}') as model
from t left join tr on t.task = tr.task""",

    "route_messages": f"""with {D},
r as (select seq, cast(ceil(length(text) / 4) as bigint) as tokens from d)
select seq as doc_id, 'summary' as task, tokens,
       case when tokens > {_REMOTE_ABOVE} then 'remote' else 'local' end as provider,
       case when tokens > {_REMOTE_ABOVE} then '{_REMOTE}' else 'llama3.1:8b' end as model
from r""",

    "sql_over_dataset": C.DATASET_SQL.format(name="documents").replace("?", str(C.SQL_MIN_CHARS)),

    "json_roundtrip": f"""with {D} select channel_id, message_id, text, content_hash from d""",

    "csv_roundtrip": f"""with {D} select channel_id, message_id, text, content_hash from d""",

    "snapshot_roundtrip": f"""with {D}, {D_FIRST}
select channel_id, message_id, cast(null as varchar) as content_hash from ds where status = 'new'
union all
select distinct cast(null as varchar), cast(null as varchar), content_hash from ds""",

    "stream_ingest": f"""with {E}, {E_FOLD} select seq as event_id, status from es""",

    "stream_bursts": f"""with {E},
l as (select e.*, lag(date) over (partition by channel_id order by date, seq) as prev_date
      from e),
s as (select l.*, case when prev_date is null
                         or {_gap('date', 'prev_date')} > {C.BURST_GAP_SECONDS}
                       then 1 else 0 end as st from l),
b as (select s.*, sum(st) over (partition by channel_id order by date, seq
                                rows between unbounded preceding and current row) as burst_id
      from s),
g as (select channel_id, min(date) as burst_start, max(date) as burst_end,
             count(*) as messages from b group by channel_id, burst_id)
select * from g""",

    "accepted_messages": f"""with {E}, {E_FOLD}
select seq as event_id, channel_id, message_id from es where status = 'new'""",

    "duplicate_messages": f"""with {E}, {E_FOLD}
select seq as event_id, message_id, {_reason()} as reason from es where status <> 'new'""",

    "ingest_conversations": f"""with {CONV_FULL}
select message_id, channel_id,
       case when row_number() over (partition by content_hash order by conv_id, turn) = 1
            then 'new' else 'dup_content' end as status
from c""",

    "dry_run_report": f"""with {D}, {_D_CHANNELS},
s as (
  select o.*, case when row_number() over (partition by content_hash
                                           order by channel_ordinal, seq) = 1
                   then 'new' else 'dup_content' end as status
  from o),
j as (
  select channel_ordinal, channel_id, count(*) as total_messages,
         count(*) filter (where status = 'new') as new_messages,
         count(*) filter (where status <> 'new') as duplicates
  from s group by channel_ordinal, channel_id)
{_with_rates('j', 'channel_ordinal, ')}""",

    "state_union": f"""with {E},
e1 as (select * from e where date < {_ts(C.SPLIT_TS)}),
e2 as (select * from e where date >= {_ts(C.SPLIT_TS)}),
{fold('e1', 'a_')},
{fold('e2', 'b_')},
k as (select * from a_kept union all select * from b_kept)
select distinct channel_id, message_id, cast(null as varchar) as content_hash from k
union all
select distinct cast(null as varchar), cast(null as varchar), content_hash from k""",

    "ingest_by_value": f"""with {V}, {fold('v')} {_folded('v')}""",

    "ingest_by_user": f"""with {U}, {fold('u')} {_folded('u')}""",

    "listed_channel_stats": f"""with {E}, {E_FOLD}, {_event_channels()},
ge as ({_stats_select('es')}),
je as (
  select chl.channel_ordinal, chl.channel as channel_id,
         cast(coalesce(ge.total_messages, 0) as bigint) as total_messages,
         cast(coalesce(ge.new_messages, 0) as bigint) as new_messages,
         cast(coalesce(ge.duplicates, 0) as bigint) as duplicates
  from chl left join ge on chl.channel = ge.channel_id)
{_with_rates('je', 'channel_ordinal, ')}""",

    "stats_rollup": f"""with {E}, {E_FOLD},
g as (select channel_id, count(*) as total_messages,
             count(*) filter (where status = 'new') as new_messages,
             count(*) filter (where status <> 'new') as duplicates
      from es group by rollup (channel_id))
{_with_rates('g')}""",

    "batch_sizes": f"""with {E},
r as (select channel_id, row_number() over (partition by channel_id order by seq) as position from e)
select channel_id, cast((position - 1) // {C.BATCH_SIZE} as bigint) as batch_number,
       count(*) as messages
from r group by all""",

    "snapshot_documents": f"""with {D}, {D_FIRST}
select '{C.PROCESSED_AT}' as saved_at, count(*) as ids, count(distinct content_hash) as hashes
from ds where status = 'new'""",

    "continued_runs": f"""with {E},
x as (select e.* replace (case when date < {_ts(C.SPLIT_TS)} then 0 else 1 end * 1000000000000 + seq as seq) from e),
{fold('x')}
select seq % 1000000000000 as event_id, status from ({_folded('x').replace('seq as event_id', 'seq')})""",

    "recorded_log": f"""with {E},
x as (select e.* replace (case when date < {_ts(C.SPLIT_TS)} then 0 else 1 end * 1000000000000 + seq as seq) from e),
{fold('x')}
select channel_id, message_id, content_hash, '{C.PROCESSED_AT.replace(' ', 'T')}' as processed_at,
       'completed' as processing_status, 0 as ai_processed
from kept""",

    "state_metadata": """select 'tracker_version' as key, '2.0.0' as value
union all select 'last_batch_id', cast(count(*) - 1 as varchar) from (
  select distinct ts < timestamp '2024-01-16 00:00:00' from events)""",

    "classify_against_recorded": f"""with {D}, {LABELLED}
select seq as doc_id,
       case when exists (select 1 from st where st.channel_id = d.channel_id and st.message_id = d.message_id)
              then 'dup_id'
            when exists (select 1 from st where st.content_hash = d.content_hash) then 'dup_content'
            else 'new' end as status
from d""",

    "event_order_ingest": f"""with {E},
x as (select e.* replace (row_number() over (order by date, seq) as seq), seq as event_id from e),
{fold('x')}
select x.event_id, f.status from x join ({_folded('x').replace('seq as event_id', 'seq')}) f on f.seq = x.seq""",

    "running_statistics": f"""with {E}, {E_FOLD},
g as ({_stats_select('es')})
select channel_id, total_messages, new_messages, duplicates, duplicate_rate_text, cast(null as bigint) as channels
from ({_with_rates('g')})
union all
select 'all', count(*), count(distinct [channel_id, message_id]), count(distinct content_hash), '2.0.0',
       count(distinct channel_id)
from kept""",

    "readmitted_messages": f"""with {E},
x as (select * from e where date >= {_AS_OF_MINUS['retention']}),
{fold('x')}
select seq as event_id, channel_id, message_id from kept""",

    "stream_first_ids": f"""with {E} select distinct channel_id, message_id from e""",

    "stream_reposts": f"""with {E},
l as (select e.*, lag(date) over (partition by channel_id, content_hash
                                  order by date, seq) as prev_date from e)
select seq as event_id, channel_id from l where {_gap('date', 'prev_date')} <= {C.REPOST_SECONDS}""",
}

# the same answers by another way
ORACLE_SQL["resumed_run"] = ORACLE_SQL["ingest_by_channel"]
ORACLE_SQL["running_daily"] = ORACLE_SQL["cumulative_daily"]
