"""Explicit schemas of the input records; nothing in the library infers a schema."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

USER_BEHAVIOR = StructType(
    [
        StructField("userId", LongType()),
        StructField("itemId", LongType()),
        StructField("categoryId", IntegerType()),
        StructField("behavior", StringType()),
        StructField("timestamp", LongType()),  # epoch seconds
    ]
)

STATE_EVENT = StructType(
    [
        StructField("time", StringType()),  # epoch milliseconds, as text
        StructField("id", StringType()),
        StructField("old_state", StringType()),
        StructField("new_state", StringType()),
        StructField("eqp_id", StringType()),
    ]
)

PASSING_RECORD = StructType(
    [
        StructField("passingTime", StringType()),  # epoch milliseconds, as text
        StructField("plateNo", StringType()),
    ]
)

MESSAGE = StructType([StructField("value", StringType())])
