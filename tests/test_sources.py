import datetime
import os

import pytest
from pyspark.sql.datasource import DataSource, DataSourceReader

from windrow.schemas import USER_BEHAVIOR
from windrow.sources.behavior import read_behavior_csv
from windrow.sources.lines import socket_lines, table_stream, text_lines
from windrow.sources.topics import TopicSpec, decode_messages, raw_messages, topic_options


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


GOOD = "1,10,3,pv,1511658000\n2,11,4,buy,1511658001\n"


def test_csv(spark, folder):
    df = read_behavior_csv(spark, _write(folder, "log.csv", GOOD))
    assert df.schema == USER_BEHAVIOR
    assert [tuple(r) for r in df.orderBy("userId").collect()] == [
        (1, 10, 3, "pv", 1511658000), (2, 11, 4, "buy", 1511658001),
    ]


def test_csv_bad_rows(spark, folder):
    path = _write(folder, "log.csv", GOOD + "x,12,5,pv,1511658002\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_behavior_csv(spark, path).collect()
    assert read_behavior_csv(spark, path).select("itemId").count() == 3  # the bad field is not asked for
    kept = read_behavior_csv(spark, path, on_bad_row="keep").collect()
    assert [r.corrupt_record for r in kept] == [None, None, "x,12,5,pv,1511658002"]
    with pytest.raises(ValueError):
        read_behavior_csv(spark, path, on_bad_row="skip")


def test_csv_stream(spark, folder):
    _write(folder, "log.csv", GOOD)
    df = read_behavior_csv(spark, folder, streaming=True, max_files_per_trigger=1)
    assert df.isStreaming
    query = df.writeStream.format("memory").queryName("csv_stream").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("csv_stream").count() == 2


def test_topic_options():
    spec = TopicSpec("a:1,b:1", "t", group_id="g", max_offsets_per_trigger=10, min_partitions=4, options={"x": "y"})
    assert topic_options(spec) == {
        "kafka.bootstrap.servers": "a:1,b:1", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "true", "kafka.group.id": "g", "minPartitions": "4", "maxOffsetsPerTrigger": "10", "x": "y",
    }
    batch = topic_options(TopicSpec("a:1", "t", ending_offsets="latest"), streaming=False)
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in batch


def test_raw_messages_through_a_source_of_the_same_shape(spark):
    """The connector itself is not installed here. (Local classes, so that they reach the workers.)"""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.topic = options["subscribe"]

        def read(self, partition):
            for offset, value in enumerate([b'{"pos":1}', b"", None]):
                yield (None, value, self.topic, 0, offset, datetime.datetime(2024, 1, 1), 0)

    class StandInTopic(DataSource):
        @classmethod
        def name(cls):
            return "stand_in_topic"

        def schema(self):
            return (
                "key binary, value binary, topic string, partition int, offset bigint, "
                "timestamp timestamp, timestampType int"
            )

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(StandInTopic)
    df = raw_messages(spark, TopicSpec("a:1", "t", format="stand_in_topic"), streaming=False)
    assert df.columns == ["value", "topic", "partition", "offset", "timestamp"]
    rows = df.orderBy("offset").collect()
    assert [r.value for r in rows] == ['{"pos":1}', "", None]
    assert {r.topic for r in rows} == {"t"}


def test_decode_messages(spark):
    rows = [(bytearray("é".encode()), "t", 0, 5, None), (None, "t", 1, 6, None)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint, timestamp timestamp")
    decoded = decode_messages(df)
    assert [r.value for r in decoded.orderBy("offset").collect()] == ["é", None]
    assert decoded.columns == ["value", "topic", "partition", "offset", "timestamp"]


def test_socket_is_a_stream_of_timed_lines(spark):
    df = socket_lines(spark, "localhost", 9)  # declared only; nothing connects
    assert df.isStreaming and df.columns == ["value", "timestamp"]


def test_text_lines(spark, folder):
    _write(folder, "a.txt", "one\n\n two \n")
    assert sorted(r.value for r in text_lines(spark, folder).collect()) == ["", " two ", "one"]
    assert text_lines(spark, folder, streaming=True).isStreaming


@pytest.mark.parametrize("single", [True, False])
def test_table_stream_of_a_file_or_a_folder(spark, folder, single):
    path = f"{folder}/t.parquet"
    spark.range(10).repartition(3).write.parquet(path)
    if single:
        path = f"{path}/" + next(n for n in sorted(os.listdir(path)) if n.startswith("part-"))
    expected = spark.read.parquet(path).count()
    stream = table_stream(spark, path, spark.range(1).schema)
    query = stream.writeStream.format("memory").queryName(f"table_{single}").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table(f"table_{single}").count() == expected
