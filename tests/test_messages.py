"""Normalisation: each field state, each reason to refuse a message."""

import datetime
import json
import random

import pytest

from windrow.operators.normalise import (
    PASSING_RECORDS,
    STATE_EVENTS,
    good_records,
    normalise_passing_records,
    normalise_state_events,
    rejects,
)


def _state(spark, *messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "n int, value string")
    return normalise_state_events(df).orderBy("n").collect()


@pytest.mark.parametrize(
    "key, field, default",
    [
        ("RAWID", "id", "Null"),
        ("RSD_02", "eqp_id", "Null"),
        ("OLD_STATE", "old_state", "Null"),
        ("NEW_STATE", "new_state", "Null"),
    ],
)
def test_field_states(spark, key, field, default):
    rows = _state(
        spark,
        '{"pos":1}',
        '{"pos":1,"%s":null,"z":1}' % key,
        '{"pos":1,"%s":null}' % key,
        '{"pos":1,"%s": null,"z":1}' % key,
        '{"pos":1,"%s":"v"}' % key,
        '{"pos":1,"%s":12}' % key,
        '{"pos":1,"%s":true}' % key,
        '{"pos":1,"%s":{"a":[1,2]}}' % key,
        '{"pos":1,"%s":""}' % key,
    )
    assert [r[field] for r in rows] == [default, "null", default, default, "v", "12", "true", '{"a":[1,2]}', ""]
    assert all(r.reject_reason is None for r in rows)


def test_time_states(spark):
    rows = _state(
        spark,
        "{}",
        '{"pos":null,"z":1}',
        '{"pos":null}',
        '{"pos":"+5"}',
        '{"pos":"-5"}',
        '{"pos":" 5"}',
        '{"pos":"5 "}',
        '{"pos":"0L"}',
        '{"pos":"1.5"}',
        '{"pos":"9223372036854775808"}',
        '{"pos":"9223372036854775807"}',
        '{"pos":"1704067200123"}',
    )
    assert [r.time for r in rows[:3]] == ["0", "null", "0"]
    bad = "bad_event_time"
    assert [r.reject_reason for r in rows] == [None, bad, None, None, None, bad, bad, bad, bad, bad, bad, None]
    assert rows[11].event_time == datetime.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert rows[0].event_time == datetime.datetime(1970, 1, 1)


def test_rewrite_is_textual(spark):
    row = _state(spark, '{"pos":1,"RAWID":"a:null,b"}')
    # the rewrite puts quotes inside the string, which breaks the message
    assert row[0].reject_reason == "malformed_json"
    df = spark.createDataFrame([('{"pos":1,"RAWID":"a:null,b"}',)], "value string")
    assert normalise_passing_records(df).first().plateNo == "a:null,b"


@pytest.mark.parametrize("message", [None, ""])
def test_empty(spark, message):
    assert _state(spark, message)[0].reject_reason == "empty_message"


@pytest.mark.parametrize(
    "message",
    [
        "not json", "  ", "null", "123", '"text"', "[]", '[{"pos":1}]', '{"pos":1', '{"pos":1} x', '{"pos":1}}',
        '{"pos":1},{"pos":2}', '{"pos":1}]', '{"pos":1}] {"pos":2}', '{"pos":1} {"pos":2}', '{"pos":1},',
    ],
)
def test_malformed(spark, message):
    row = _state(spark, message)[0]
    assert row.reject_reason == "malformed_json"
    assert row.id is None and row.event_time is None


@pytest.mark.parametrize("message", [' {"pos":1} \n', "{'pos':1}", "{pos:1}", '{"pos":1,"RAWID":"a\tb"}'])
def test_tolerated_spellings(spark, message):
    assert _state(spark, message)[0].reject_reason is None


def test_last_of_equal_keys_and_case_of_keys(spark):
    rows = _state(spark, '{"pos":1,"RAWID":"a","RAWID":"b"}', '{"pos":1,"rawid":"a"}')
    assert [r.id for r in rows] == ["b", "Null"]


def test_passing_records(spark):
    df = spark.createDataFrame(
        [
            ('{"RAWID":"P1","pos":"1000","RSD_02":"x","op_ts":"9"}',),
            ('{"pos":1000}',),
            ('{"RAWID":null,"pos":1000}',),
            ('{"RAWID":"P2"}',),
            ('{"RAWID":"P3","pos":null,"z":1}',),
        ],
        "value string",
    )
    rows = normalise_passing_records(df).collect()
    assert [(r.passingTime, r.plateNo, r.reject_reason) for r in rows] == [
        ("1000", "P1", None),
        ("1000", "Null", None),
        ("1000", "Null", None),
        ("0L", "P2", "bad_event_time"),
        ("0L", "P3", "bad_event_time"),
    ]


def test_every_message_goes_one_way(spark):
    messages = ['{"pos":1}', "", "x", '{"pos":"y"}', None, '{"pos":2}']
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "n int, value string")
    normalised = normalise_state_events(df)
    good, bad = good_records(normalised), rejects(normalised, STATE_EVENTS)
    assert good.columns == ["n", *STATE_EVENTS.fields, "event_time"]
    assert bad.columns == ["n", "value", "reject_reason"]
    assert sorted([r.n for r in good.collect()] + [r.n for r in bad.collect()]) == list(range(6))
    assert set(PASSING_RECORDS.fields) == {"passingTime", "plateNo"}


def test_random_messages(spark):
    """Against the table of field states, on messages put together at random."""
    rng = random.Random(5)
    keys = {"id": "RAWID", "time": "pos", "eqp_id": "RSD_02", "old_state": "OLD_STATE", "new_state": "NEW_STATE"}
    messages, expected = [], []
    for n in range(400):
        fields, record = list(keys), dict.fromkeys(keys)
        rng.shuffle(fields)
        fields = [f for f in fields if rng.random() < 0.8]
        texts = []
        for at, field in enumerate(fields):
            last = at == len(fields) - 1
            kind = rng.choice(["text", "number", "null", "spaced null"])
            if kind == "text":
                record[field] = str(rng.randrange(10**12))
                texts.append(f'"{keys[field]}":"{record[field]}"')
            elif kind == "number":
                record[field] = str(rng.randrange(10**12))
                texts.append(f'"{keys[field]}":{record[field]}')
            elif kind == "null":
                record[field] = None if last else "null"
                texts.append(f'"{keys[field]}":null')
            else:
                texts.append(f'"{keys[field]}": null')
        defaults = {f: "0" if f == "time" else "Null" for f in keys}
        messages.append((n, "{" + ",".join(texts) + "}"))
        expected.append({f: record[f] if record[f] is not None else defaults[f] for f in keys})
    df = spark.createDataFrame(messages, "n int, value string")
    for row, want in zip(normalise_state_events(df).orderBy("n").collect(), expected):
        assert {f: row[f] for f in keys} == want, row.value
        assert row.reject_reason == ("bad_event_time" if want["time"] == "null" else None)


def test_forged_tail_and_poison_times(spark):
    messages = [
        ('{"RAWID":"a","pos":1},{}] garbage', "malformed_json"),
        ('{"RAWID":"a","pos":1},{"_end_of_message":"1"}]', "malformed_json"),
        ('{"RAWID":"a","pos":9223372036854775}', "bad_event_time"),
        ('{"RAWID":"a","pos":-62135596800001}', "bad_event_time"),
        ('{"RAWID":"a","pos":253402300800000}', "bad_event_time"),
        ('{"RAWID":"a","pos":253402300799999}', None),
        ('{"RAWID":"a","pos":-62135596800000}', None),
    ]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(messages)], "n int, value string")
    found = normalise_state_events(df).select("n", "reject_reason").orderBy("n").collect()
    assert [r[1] for r in found] == [reason for _, reason in messages]


@pytest.mark.parametrize(
    "text, shown",
    [
        ("1.50", "1.50"),
        ("12345678901234567890.123", "12345678901234567890.123"),
        ("-0.10 ", "-0.10"),
        ("1.5E-3", "1.5E-3"),
        ("1e400", "1e400"),
        ("7", "7"),
        ("[1.50, 2,-0.0]", "[1.50,2,-0.0]"),
        ('{"a":{"b":[1.50]},"c":"1.50,"}', '{"a":{"b":[1.50]},"c":"1.50,"}'),
        ('"1.50,"', "1.50,"),
        (r'"a\"1.50,"', 'a"1.50,'),
        (r'"a\\"', "a\\"),
        ("'it\"s 1.50,'", 'it"s 1.50,'),
        (r"'it\'s 1.50,'", "it's 1.50,"),
    ],
)
def test_numbers_as_written(spark, text, shown):
    row = _state(spark, '{"pos":1,"RAWID":%s,"OLD_STATE":2.50}' % text)[0]
    assert (row.id, row.old_state, row.reject_reason) == (shown, "2.50", None)


@pytest.mark.parametrize(
    "message",
    [
        '{"pos":1,"RAWID":1.}', '{"pos":1,"RAWID":.5}', '{"pos":1,"RAWID":1.5 x}', '{1.5:2,"pos":1}', '{"pos":1} 1.5,', '1.5',
        '{"pos":1,"RAWID":x 1.5}', '{"pos":1,"RAWID":--1.5}', r'{"pos":1,"RAWID":"\q1.5"}', '{"pos":1,"RAWID":"1.5,}', '{"pos":1,"RAWID":1.5',
    ],
)
def test_numbers_mend_no_message(spark, message):
    assert _state(spark, message)[0].reject_reason == "malformed_json"


def test_numbers_in_a_long_message(spark):
    shown = '"\\1.50,' * 60_000
    row = _state(spark, '{"pos":1,"a":[%s1.50],"RAWID":%s,"OLD_STATE":1.70}' % ("1.50," * 60_000, json.dumps(shown)))[0]
    assert row.id == shown and row.old_state == "1.70" and row.reject_reason is None
