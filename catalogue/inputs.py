"""The given tables, read as the inputs of the library's jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from windrow.sources.lines import table_stream

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
CONVERSATIONS = StructType(
    [StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("text", StringType())]
)
SCHEMAS = {"events": EVENTS, "documents": DOCUMENTS, "conversations": CONVERSATIONS}


def table(spark: SparkSession, sf_dir: str, name: str, *, streaming: bool = False) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if streaming:
        return table_stream(spark, path, SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def behavior(events: DataFrame) -> DataFrame:
    """Events as a behaviour log, timed in whole seconds; a `view` is a page view."""
    item = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type"))
    return events.select(
        F.col("user_id").alias("userId"),
        item.alias("itemId"),
        F.pmod(item, F.lit(10)).cast("int").alias("categoryId"),
        kind.alias("behavior"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
    )


def views(events: DataFrame) -> DataFrame:
    """Page views with their event time in full precision: `itemId, event_time`."""
    return (
        events.filter(F.col("event_type") == "view")
        .select(
            F.get_json_object("props", "$.k").cast("bigint").alias("itemId"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )
        .withWatermark("event_time", "0 seconds")
    )


def _json_message() -> Column:
    """The message an event stands for: each kind of field value, absence and null occurs."""
    number = F.col("event_id")
    user = F.col("user_id").cast("string")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    kind = F.col("event_type")

    def text(*pieces: str | Column) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in pieces))

    return (
        F.when(number % 50 == 7, F.lit(""))
        .when(number % 50 == 8, F.lit("not json"))
        .when(number % 50 == 9, text('{"RAWID":', user, ',"pos":null,"RSD_02":"E1"}'))
        .when(
            number % 5 == 0,
            text(
                '{"RAWID":"', user, '","pos":"', millis, '","RSD_02":"E', (number % 20).cast("string"),
                '","OLD_STATE":"', kind, '","NEW_STATE":null}',
            ),
        )
        .when(
            number % 5 == 1,
            text('{"RAWID":', user, ',"pos":', millis, ',"RSD_02":null,"OLD_STATE":"', kind, '","NEW_STATE":"IDLE"}'),
        )
        .when(
            number % 5 == 2,
            text('{"RAWID":', user, ',"pos":', millis, ',"OLD_STATE": null,"NEW_STATE":"', kind, '"}'),
        )
        .when(number % 5 == 3, text('{"pos":"', millis, '","RSD_02":"E1","NEW_STATE":"', kind, '"}'))
        .otherwise(text('{"RAWID":"', user, '","RSD_02":"E2","OLD_STATE":"RUN","NEW_STATE":"', kind, '"}'))
    )


def _position() -> Column:
    """The place of an event in an arrival order that is not the order of times.

    The order is by `event_id + event_id*7919 % 17`, then by `event_id`. Ids of equal sums differ
    by at most 16, so sum and id fit one number: `17 * sum + (16 - event_id*7919 % 17)`.
    """
    number = F.col("event_id")
    shift = (number * 7919) % 17
    return (number + shift) * 17 + (16 - shift)


def messages(events: DataFrame) -> DataFrame:
    """Every event as a raw JSON message with its number, arrival time and place of arrival."""
    return events.select(
        _json_message().alias("value"),
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        _position().alias("position"),
    )


def number_messages(events: DataFrame) -> DataFrame:
    """Every event as a message with numbers of fraction and exponent: at the top, in objects and arrays, beside strings
    that look alike, beside escaped quotes, longer than any number type."""
    number = F.col("event_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    fraction = F.concat(F.col("user_id").cast("string"), F.lit("."), F.lpad((number % 1000).cast("string"), 3, "0"), F.lit("0"))

    def message(text: str) -> Column:
        filled = F.replace(F.lit(text), F.lit("FRACTION"), fraction)
        return F.replace(filled, F.lit("MILLIS"), millis)

    value = (
        F.when(number % 4 == 0, message('{"RAWID":FRACTION,"pos":MILLIS,"OLD_STATE":{"v":FRACTION,"w":[1, -FRACTION]},"NEW_STATE":7e+2}'))
        .when(number % 4 == 1, message('{"RAWID":"FRACTION,1.50}","pos":MILLIS,"OLD_STATE":12345678901234567890FRACTION}'))
        .when(number % 4 == 2, message('{"RAWID":"a\\"FRACTION,\\\\","pos":MILLIS,"OLD_STATE": -0.10 ,"NEW_STATE":true,"RSD_02":"1.0"}'))
        .otherwise(message('{"pos": FRACTION,"RAWID":FRACTION}'))
    )
    return events.select(value.alias("value"), "event_id")


def arrivals(events: DataFrame) -> DataFrame:
    """All events with their place of arrival."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        _position().alias("position"),
        (F.col("event_id") % 4).alias("source_partition"),
    )


def document_lines(documents: DataFrame) -> DataFrame:
    """Whole documents as text lines, one arriving each second."""
    return documents.select(F.col("text").alias("value"), F.timestamp_seconds("doc_id").alias("timestamp"))


def turn_lines(conversations: DataFrame) -> DataFrame:
    """Whole turns as text lines; a conversation begins each second, its turns come at once."""
    return conversations.select(F.col("text").alias("value"), F.timestamp_seconds("conv_id").alias("timestamp"))
