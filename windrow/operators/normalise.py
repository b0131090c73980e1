"""Raw JSON messages to fixed records, with a quarantine for the ones that cannot be used."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.constants import PASSING_RECORD_KEYS, STATE_EVENT_KEYS
from windrow.functions.clock import micros_time, millis_micros, strict_long
from windrow.functions.messages import (
    field_or_default,
    is_one_object,
    mark_literals,
    message_mark,
    parse_object,
    quote_nulls,
    seems_literal,
    written,
)
from windrow.operators.event_time import EVENT_TIME

REJECT_REASON = "reject_reason"

EMPTY_MESSAGE = "empty_message"
MALFORMED_JSON = "malformed_json"
BAD_EVENT_TIME = "bad_event_time"


@dataclass(frozen=True)
class RecordSpec:
    """How a message becomes a record: output field -> (JSON key, default), which of the fields is
    the event time in epoch milliseconds, and whether nulls before a comma become text first."""

    keys: Mapping[str, tuple[str, str]]
    time_field: str
    nulls_to_text: bool = False

    @property
    def fields(self) -> list[str]:
        return list(self.keys)


STATE_EVENTS = RecordSpec(STATE_EVENT_KEYS, time_field="time", nulls_to_text=True)
PASSING_RECORDS = RecordSpec(PASSING_RECORD_KEYS, time_field="passingTime")


def normalise(df: DataFrame, spec: RecordSpec, value: str = "value") -> DataFrame:
    """Add the record's fields, `event_time` and `reject_reason` (null for usable messages).

    All other columns of `df` stay. Each message is parsed once, on the JVM, and every message
    comes out: `good_records` and `rejects` part them. Numbers come out as they are written.
    """
    message = F.col(value)
    text = quote_nulls(message) if spec.nulls_to_text else message
    names = spec.fields

    def hashed(t: Column) -> Column:
        return F.struct(t.alias("text"), message_mark(t).alias("mark"), seems_literal(t).alias("literal"))

    def parsed(s: Column) -> Column:
        marked = F.when(s["literal"], mark_literals(s["text"], s["mark"])).otherwise(s["text"])
        return F.struct(*(s[n].alias(n) for n in ("text", "mark", "literal")), parse_object(marked, spec.keys, s["mark"]).alias("parsed"))

    def judged(s: Column) -> Column:
        whole = is_one_object(s["parsed"], s["text"])
        return F.struct(*(s[n].alias(n) for n in ("mark", "literal", "parsed")), whole.alias("whole"))

    def field(s: Column, key: str, default: str) -> Column:
        value = field_or_default(s["parsed"], key, default)
        return F.when(s["whole"], F.when(s["literal"], written(value, s["mark"])).otherwise(value))

    def recorded(s: Column) -> Column:
        fields = (field(s, key, default).alias(n) for n, (key, default) in spec.keys.items())
        return F.struct(s["whole"].alias("_whole"), *fields)

    def numbered(s: Column) -> Column:
        micros = millis_micros(strict_long(s[spec.time_field]))
        return F.struct(s["_whole"].alias("_whole"), *(s[n].alias(n) for n in names), micros.alias("micros"))

    def timed(s: Column) -> Column:
        return F.struct(s["_whole"].alias("_whole"), *(s[n].alias(n) for n in names), micros_time(s["micros"]).alias(EVENT_TIME))

    # one row at a time through an array of one: each step names what the step before worked out. The whole goes through a
    # generator: a filter on the fields would otherwise be moved below the projection and work everything out again
    steps = F.array(text)
    for step in (hashed, parsed, judged, recorded, numbered, timed):
        steps = F.transform(steps, step)
    records = df.select(*df.columns, F.inline(steps))
    reason = (
        F.when(message.isNull() | (F.length(message) == 0), EMPTY_MESSAGE)
        .when(~F.col("_whole"), MALFORMED_JSON)
        .when(F.col(EVENT_TIME).isNull(), BAD_EVENT_TIME)
    )
    return records.withColumn(REJECT_REASON, reason).drop("_whole")


def normalise_state_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Equipment-state messages: `time, id, old_state, new_state, eqp_id`."""
    return normalise(df, STATE_EVENTS, value)


def normalise_passing_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Passing records: `passingTime, plateNo`. A message without a time has the default `0L`,
    which is not a number, and so is rejected."""
    return normalise(df, PASSING_RECORDS, value)


def good_records(normalised: DataFrame, value: str = "value") -> DataFrame:
    """The usable records, without the raw message."""
    return normalised.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON, value)


def rejects(normalised: DataFrame, spec: RecordSpec) -> DataFrame:
    """The quarantined messages: raw value, reason and whatever columns came with the message."""
    return normalised.filter(F.col(REJECT_REASON).isNotNull()).drop(*spec.fields, EVENT_TIME)
