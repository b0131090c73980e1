"""The same results in SQL, for DuckDB on the same tables."""

from __future__ import annotations

# --- shared parts ------------------------------------------------------------------------------------

_VIEWS = """
views as (
  select ts, cast(json_extract_string(props, '$.k') as bigint) as item
  from events where event_type = 'view'
)"""

_COUNTS = """
spread as (
  select item, time_bucket(interval 5 minute, ts) + (k + 1) * interval 5 minute as window_end
  from {views}, range(12) as t(k)
),
counts as (select window_end, item, count(*) as n from spread group by all),
ranked as (
  select *, row_number() over (partition by window_end order by n desc, item) as rk from counts
)"""

_HOT = f"with {_VIEWS}, {_COUNTS.format(views='views')}"

_CLOSED_VIEWS = "window_end <= (select max(ts) from views)"

_TOP = """
select window_end, item as "itemId", n as view_count, rk as rank
from ranked where rk <= 3"""

_TOP_5000 = _TOP.replace("rk <= 3", "rk <= 5000")

_REPORT = """
select window_end,
  repeat('=', 37) || chr(10)
  || '时间： ' || strftime(window_end + interval 8 hour, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
  || string_agg('No' || (rk - 1) || ':  商品ID=' || item || '  浏览量=' || n || chr(10), '' order by rk)
  || repeat('=', 37) || chr(10) || chr(10) as report
from ranked where rk <= 3"""

_MESSAGES = """
messages as (
  select event_id, ts,
    case
      when event_id % 50 = 7 then ''
      when event_id % 50 = 8 then 'not json'
      when event_id % 50 = 9 then '{"RAWID":' || user_id || ',"pos":null,"RSD_02":"E1"}'
      when event_id % 5 = 0 then '{"RAWID":"' || user_id || '","pos":"' || epoch_us(ts) // 1000
        || '","RSD_02":"E' || event_id % 20 || '","OLD_STATE":"' || event_type || '","NEW_STATE":null}'
      when event_id % 5 = 1 then '{"RAWID":' || user_id || ',"pos":' || epoch_us(ts) // 1000
        || ',"RSD_02":null,"OLD_STATE":"' || event_type || '","NEW_STATE":"IDLE"}'
      when event_id % 5 = 2 then '{"RAWID":' || user_id || ',"pos":' || epoch_us(ts) // 1000
        || ',"OLD_STATE": null,"NEW_STATE":"' || event_type || '"}'
      when event_id % 5 = 3 then '{"pos":"' || epoch_us(ts) // 1000
        || '","RSD_02":"E1","NEW_STATE":"' || event_type || '"}'
      else '{"RAWID":"' || user_id || '","RSD_02":"E2","OLD_STATE":"RUN","NEW_STATE":"' || event_type || '"}'
    end as value
  from events
)"""

_STATE = f"""{_MESSAGES},
texts as (select *, replace(value, ':null,', ':"null",') as txt from messages),
fields as (
  select event_id, ts, value,
    case when json_valid(txt) then coalesce(json_extract_string(txt, '$.pos'), '0') end as time,
    case when json_valid(txt) then coalesce(json_extract_string(txt, '$.RAWID'), 'Null') end as id,
    case when json_valid(txt) then coalesce(json_extract_string(txt, '$.OLD_STATE'), 'Null') end as old_state,
    case when json_valid(txt) then coalesce(json_extract_string(txt, '$.NEW_STATE'), 'Null') end as new_state,
    case when json_valid(txt) then coalesce(json_extract_string(txt, '$.RSD_02'), 'Null') end as eqp_id
  from texts
),
judged as (
  select *,
    case when value = '' then 'empty_message'
         when id is null then 'malformed_json'
         when not regexp_full_match(time, '[+-]?[0-9]+') then 'bad_event_time' end as reject_reason
  from fields
),
good as (
  select *, make_timestamp(cast(time as bigint) * 1000) as event_time
  from judged where reject_reason is null
)"""

_PASSING = f"""{_MESSAGES},
fields as (
  select event_id, ts, value,
    case when json_valid(value) then coalesce(json_extract_string(value, '$.pos'), '0L') end as "passingTime",
    case when json_valid(value) then coalesce(json_extract_string(value, '$.RAWID'), 'Null') end as "plateNo"
  from messages
),
judged as (
  select *,
    case when value = '' then 'empty_message'
         when "plateNo" is null then 'malformed_json'
         when not regexp_full_match("passingTime", '[+-]?[0-9]+') then 'bad_event_time' end as reject_reason
  from fields
),
good as (
  select *, make_timestamp(cast("passingTime" as bigint) * 1000) as event_time
  from judged where reject_reason is null
)"""

_STATE_FIELDS = "time, id, old_state, new_state, eqp_id"
_PASSING_FIELDS = '"passingTime", "plateNo"'


_NUMBER_TEXT = """
with numbers as (
  select event_id, event_id % 4 as kind, cast(epoch_us(ts) // 1000 as varchar) as millis,
    user_id || '.' || lpad(cast(event_id % 1000 as varchar), 3, '0') || '0' as fraction
  from events
)
select event_id,
  case when kind = 3 then fraction else millis end as time,
  case kind when 1 then fraction || ',1.50}' when 2 then 'a"' || fraction || ',\\' else fraction end as id,
  case kind when 0 then '{"v":' || fraction || ',"w":[1,-' || fraction || ']}'
    when 1 then '12345678901234567890' || fraction when 2 then '-0.10' else 'Null' end as old_state,
  case kind when 0 then '7e+2' when 2 then 'true' else 'Null' end as new_state,
  case kind when 2 then '1.0' else 'Null' end as eqp_id,
  case when kind = 3 then 'bad_event_time' end as reject_reason
from numbers"""


def _window(size: int, time: str = "event_time") -> str:
    return (
        f"time_bucket(interval {size} second, {time}) as window_start, "
        f"time_bucket(interval {size} second, {time}) + interval {size} second as window_end"
    )


def _bucket(pattern: str, time: str = "event_time") -> str:
    return f"strftime({time} + interval 8 hour, '{pattern}') as bucket"


def _on_time(size: int) -> str:
    """Of `good`, what a watermark that moves with every record lets through."""
    return f"""windowed as (select *, {_window(size)} from good),
replayed as (
  select *,
    epoch_us(window_end) // 1000 - 1 <= max(greatest(epoch_us(event_time) // 1000, 0)) over (
      order by event_id + (event_id * 7919) % 17, event_id
      rows between unbounded preceding and 1 preceding) as is_late
  from windowed
),
kept as (select * from replayed where not coalesce(is_late, false))"""


_ARRIVALS = """
arrivals as (
  select event_id, ts, event_id % 4 as source_partition, epoch_us(ts) // 1000 as ms,
    event_id + (event_id * 7919) % 17 as arrival
  from events
)"""


def _audited(by: str = "") -> str:
    return f"""with {_ARRIVALS},
audited as (
  select *, time_bucket(interval 60 minute, ts) + interval 60 minute as window_end,
    coalesce(
      epoch_us(time_bucket(interval 60 minute, ts) + interval 60 minute) // 1000 - 1
        <= max(ms) over ({by} order by arrival, event_id rows between unbounded preceding and 1 preceding),
      false) as is_late
  from arrivals
)"""


_LINES = {
    "documents": "lines as (select text as value, make_timestamp(doc_id * 1000000) as ts from documents)",
    "conversations": "lines as (select text as value, make_timestamp(conv_id * 1000000) as ts from conversations)",
}

_WORDS = r"""
words as (
  select ts, unnest(
    case when value = '' then ['']
         when regexp_full_match(value, '\s+') then []::varchar[]
         else regexp_split_to_array(regexp_replace(value, '\s+$', ''), '\s') end) as word
  from lines
)"""


def _word_windows(table: str) -> str:
    return f"""with {_LINES[table]}, {_WORDS},
counted as (
  select word, {_window(5, 'ts')}, count(*) as cnt from words group by all
)
select word, window_start, window_end, cnt from counted"""


_MESSAGE_COUNT = "select lower(text) as word, count(*) as cnt from documents where text <> '' group by all"

_BEHAVIOR = """
behavior as (
  select user_id as "userId", cast(json_extract_string(props, '$.k') as bigint) as "itemId",
    cast(cast(json_extract_string(props, '$.k') as bigint) % 10 as integer) as "categoryId",
    case when event_type = 'view' then 'pv' else event_type end as behavior,
    epoch_us(ts) // 1000000 as "timestamp"
  from events
)"""

_POSITION = "(event_id + (event_id * 7919) % 17) * 17 + 16 - (event_id * 7919) % 17"


def _stage(position: str, stages: int, table: str) -> str:
    """The stage of a row: stretches of equal span of the positions of a table."""
    low, high = (f"(select {f}({position}) from {table})" for f in ("min", "max"))
    return f"({position} - {low}) // ((({high} - {low} + 1) + {stages} - 1) // {stages})"


# --- by query ----------------------------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "pv_filter": f"""with {_BEHAVIOR}
select *, make_timestamp("timestamp" * 1000000) as event_time from behavior where behavior = 'pv'""",
    "behavior_csv_roundtrip": f"with {_BEHAVIOR} select * from behavior",
    "behavior_csv_hot_items": f"""with {_BEHAVIOR},
seconds as (
  select make_timestamp("timestamp" * 1000000) as ts, "itemId" as item from behavior where behavior = 'pv'
), {_COUNTS.format(views='seconds')} {_TOP}""",
    "item_window_counts": f'{_HOT} select item as "itemId", window_end, n as view_count from counts',
    "hot_items_topn": f"{_HOT} {_TOP}",
    "hot_items_top5000": f"{_HOT} {_TOP_5000}",
    "hot_items_report": f"{_HOT} {_REPORT} group by window_end",
    "tumbling_value_sum": f"""select event_type, {_window(3600, 'ts')}, cast(sum(user_id) as bigint) as user_sum
from events group by all""",
    "state_events_normalised": f"with {_STATE} select event_id, {_STATE_FIELDS}, event_time from good",
    "state_events_rejects": f"""with {_STATE}
select event_id, value, reject_reason from judged where reject_reason is not null""",
    "state_events_number_text": _NUMBER_TEXT,
    "passing_records_normalised": f"with {_PASSING} select event_id, {_PASSING_FIELDS}, event_time from good",
    "passing_records_rejects": f"""with {_PASSING}
select event_id, value, reject_reason from judged where reject_reason is not null""",
    "state_events_windowed": f"with {_STATE} select event_id, {_STATE_FIELDS}, {_window(10)} from good",
    "passing_records_windowed": f"with {_PASSING} select event_id, {_PASSING_FIELDS}, {_window(60)} from good",
    "state_events_on_time": f"""with {_STATE}, {_on_time(10)}
select event_id, {_STATE_FIELDS}, window_start, window_end from kept""",
    "passing_records_on_time": f"""with {_PASSING}, {_on_time(60)}
select event_id, {_PASSING_FIELDS}, window_start, window_end from kept""",
    "state_events_key_window_counts": f"""with {_STATE}
select id, {_window(10)}, count(*) as cnt from good group by all""",
    "event_time_watermark": f"""with {_ARRIVALS}
select event_id,
  max(ms) over (order by arrival, event_id rows between unbounded preceding and 1 preceding) as watermark_before,
  max(ms) over (order by arrival, event_id rows between unbounded preceding and current row) as watermark_after
from arrivals""",
    "late_audit": f"{_audited()} select event_id, window_end, is_late from audited",
    "late_audit_by_partition": f"""{_audited('partition by source_partition')}
select event_id, source_partition, window_end, is_late from audited""",
    "on_time_records": f"""{_audited()}
select event_id, ts as event_time, window_end from audited where not is_late""",
    "message_running_count": _MESSAGE_COUNT,
    "message_word_count": r"""with words as (
  select unnest(regexp_split_to_array(lower(text), '\W+')) as word from documents
)
select word, count(*) as cnt from words where word <> '' group by all""",
    "word_count": f"""with {_LINES['documents']}, {_WORDS}
select word, count(*) as cnt from words group by all""",
    "windowed_word_count": _word_windows("conversations"),
    "windowed_word_count_documents": _word_windows("documents"),
    "bucket_names": """select event_id,
  strftime(ts + interval 8 hour, '%Y-%m-%d--%H%M') as minute_bucket,
  strftime(ts + interval 8 hour, '%Y-%m-%d') as day_bucket
from events""",
    "bucketed_parquet_roundtrip": f"""with {_PASSING}
select {_PASSING_FIELDS}, {_bucket('%Y-%m-%d')} from good""",
    "bucketed_json_lines_roundtrip": f"""with {_STATE}
select {_STATE_FIELDS}, {_bucket('%Y-%m-%d')} from good""",
    "bucketed_text_roundtrip": f"""with {_MESSAGES}
select value, {_bucket('%Y-%m-%d', 'ts')} from messages""",
    "compacted_buckets": f"""select event_id, ts as event_time, value, {_bucket('%Y-%m-%d', 'ts')} from events""",
    "hot_items_stream": f"{_HOT} {_TOP} and {_CLOSED_VIEWS}",
    "hot_items_report_stream": f"{_HOT} {_REPORT} and {_CLOSED_VIEWS} group by window_end",
    "window_release_stream": f"""with {_STATE},
windowed as (select *, {_window(10)} from good)
select event_id, {_STATE_FIELDS}, window_start, window_end, {_bucket('%Y-%m-%d')}
from windowed where window_end <= (select max(event_time) from good)""",
    "passing_records_stream": f"""with {_PASSING},
windowed as (select *, {_window(60)} from good)
select {_PASSING_FIELDS}, {_bucket('%Y-%m-%d')}
from windowed where window_end <= (select max(event_time) from good)""",
    "message_log_stream": f"with {_MESSAGES} select value, {_bucket('%Y-%m-%d', 'ts')} from messages",
    "running_count_stream": _MESSAGE_COUNT,
    "windowed_word_count_stream": f"""{_word_windows('conversations')}
where window_end <= (select max(ts) from lines)""",
    "fan_out_stream": f"""with {_MESSAGES},
sinks as (select unnest(['parquet', 'text']) as sink)
select sink, {_bucket('%Y-%m-%d', 'ts')}, value, count(*) as cnt from messages, sinks group by all""",
    "window_release_late_stream": f"""with {_STATE},
windowed as (select *, {_window(3600)}, {_stage(_POSITION, 4, 'events')} as stage from good),
judged_late as (
  select w.*, w.window_end <= (select max(event_time) from windowed e where e.stage < w.stage) as is_late from windowed w
)
select event_id, {_STATE_FIELDS}, window_start, window_end, {_bucket('%Y-%m-%d')}
from judged_late where not coalesce(is_late, false) and window_end <= (select max(event_time) from good)""",
    "running_count_restart_stream": _MESSAGE_COUNT,
    "running_count_folded_stream": _MESSAGE_COUNT,
    "hot_items_timer_stream": f"{_HOT} {_TOP} and {_CLOSED_VIEWS}",
    "hot_items_all_behavior_stream": f"""with {_BEHAVIOR},
seconds as (
  select make_timestamp("timestamp" * 1000000) as ts, "itemId" as item from behavior where behavior = 'pv'
), {_COUNTS.format(views='seconds')} {_TOP} and window_end <= (select make_timestamp(max("timestamp") * 1000000) from behavior)""",
    "records_and_rejects_stream": f"""with {_STATE},
both_kinds as (
  select id, time, {_bucket('%Y-%m-%d')}, null::varchar as reject_reason from good
  union all select null, null, null, reject_reason from judged where reject_reason is not null
)
select id, time, bucket, reject_reason, count(*) as cnt from both_kinds group by all""",
}
