"""The command line, on folders."""

import os

import pytest

from windrow.__main__ import main
from windrow.operators.normalise import STATE_EVENTS
from windrow.schemas import STATE_EVENT
from windrow.sinks.buckets import read_bucketed
from windrow.streaming import latest_totals


def _lines(folder, *lines):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/a.txt", "w", encoding="utf-8") as out:
        out.write("".join(f"{line}\n" for line in lines))
    return f"{folder}/in"


def test_hot_items(spark, folder, capsys):
    rows = [(u, item, 1, "pv", 1_704_067_200 + 60 * u) for u, item in enumerate([7, 7, 8])]
    rows += [(9, 9, 1, "pv", 1_704_067_200 + 7_200), (9, 7, 1, "buy", 1_704_067_200)]
    source = _lines(folder, *(",".join(map(str, r)) for r in rows))
    job = ["hot-items", "--input", source, "--once", "--zone", "Asia/Shanghai"]
    main([*job, "--checkpoint", f"{folder}/s1", "--output", f"{folder}/out"])
    reports = [r.report for r in spark.read.parquet(f"{folder}/out").orderBy("window_end").collect()]
    assert "时间： 2024-01-01 08:05:00.0\nNo0:  商品ID=7  浏览量=2\nNo1:  商品ID=8  浏览量=1\n" in reports[0]
    main([*job, "--checkpoint", f"{folder}/s2"])
    assert capsys.readouterr().out == "".join(reports)


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_state_events(spark, folder, fmt):
    source = _lines(folder, '{"pos":1000,"RAWID":"r"}', "broken", '{"pos":20000}')
    main([
        "state-events", "--files", source, "--output", f"{folder}/out", "--format", fmt, "--once",
        "--checkpoint", f"{folder}/state", "--rejects", f"{folder}/rejects",
    ])
    stored = read_bucketed(spark, f"{folder}/out", STATE_EVENT, "json" if fmt == "text" else fmt)
    assert [tuple(r) for r in stored.select(*STATE_EVENTS.fields, "bucket").collect()] == [
        ("1000", "r", "Null", "Null", "Null", "1970-01-01--0800"),
    ]
    assert [r.value for r in spark.read.json(f"{folder}/rejects").collect()] == ["broken"]


def test_message_jobs(spark, folder):
    source = _lines(folder, "A", "b", "a")
    main(["message-counts", "--files", source, "--output", f"{folder}/counts", "--once", "--checkpoint", f"{folder}/s1"])
    assert {r.word: r.cnt for r in latest_totals(spark, f"{folder}/counts", ["word"]).collect()} == {"a": 2, "b": 1}
    main(["message-log", "--files", source, "--output", f"{folder}/log", "--once", "--checkpoint", f"{folder}/s2"])
    assert sorted(r.value for r in spark.read.text(f"{folder}/log").collect()) == ["A", "a", "b"]
    main(["passing-records", "--files", source, "--output", f"{folder}/p", "--once", "--checkpoint", f"{folder}/s3"])


def test_word_counts(spark, folder):
    source = _lines(folder, "x y x")
    main(["word-counts", "--files", source, "--once", "--checkpoint", f"{folder}/state"])  # prints from the JVM
    assert "0" in os.listdir(f"{folder}/state/commits")


def test_bad_arguments():
    with pytest.raises(SystemExit):
        main(["message-log", "--output", "o", "--checkpoint", "s"])
