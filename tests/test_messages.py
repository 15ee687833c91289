import json
import math

import pytest
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import MEASURES, MESSAGE_FIELDS
from machpulse.sources import messages, streams
from tests.helpers import READING, at, message


def parsed(spark, *values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    return messages.parse_messages(df).orderBy("i").collect()


def reasons(spark, *values):
    return [r["malformed_reason"] for r in parsed(spark, *values)]


def test_sample_message(spark):
    text = (
        '{"machine_id":1,"datetime_mes":"2026-01-15T06:00:00","volt":176.21,"rotate":418.50,"pressure":113.07,'
        '"vibration":45.08}'
    )
    (row,) = parsed(spark, text)
    assert row["malformed_reason"] is None
    assert [row[f] for f in MESSAGE_FIELDS] == [1, at("2026-01-15T06:00:00"), 176.21, 418.5, 113.07, 45.08]


def test_structure(spark):
    assert reasons(
        spark,
        "{machine: 7",
        '{"machine_id":1,"volt":176.2}',
        message(machine_id="sept"),
        "5",
        "null",
        "[1]",
        f"[{message()}]",
        "",
        None,
        message()[:-1],
        message() + " trailing",
        message() + message(),
        f"{message()},{message()}",
        message(volt=None),
        message(volt=[1]),
        message(volt="abc"),
    ) == ["json_invalide", "champ_manquant", "type_invalide"] + ["json_invalide"] * 10 + [
        "champ_manquant",
        "type_invalide",
        "type_invalide",
    ]


def test_unknown_keys_and_spaces_are_ignored(spark):
    assert reasons(spark, message(extra={"a": [1, 2]}), f"  {message()}\n") == [None, None]


def test_number_spellings(spark):
    texts = [
        message(machine_id="12", volt="1e3", rotate=" 12 ", pressure="+5", vibration=".5"),
        message(volt="nan", rotate="inf", pressure="-inf", vibration="Infinity"),
        message(volt=float("nan"), rotate=float("inf"), pressure=float("-inf")),
    ]
    first, second, third = parsed(spark, *texts)
    assert [first[f] for f in ("machine_id", *MEASURES)] == [12, 1000.0, 12.0, 5.0, 0.5]
    for row in (second, third):
        assert row["malformed_reason"] is None
        assert math.isnan(row["volt"]) and row["rotate"] == math.inf and row["pressure"] == -math.inf
    assert reasons(spark, message(volt="1.0d"), message(volt="2f"), message(volt="0x1p3"), message(volt="1_000")) == [
        "type_invalide"
    ] * 4


def test_machine_ids(spark):
    ids = [0, 65535, 65536, 2**31 - 1, 2**31, -1, 1.0, 1.9, "1.9", True]
    assert reasons(spark, *[message(machine_id=i) for i in ids]) == [None] * 4 + ["type_invalide"] * 2 + [None] + [
        "type_invalide"
    ] * 3
    sent = spark.createDataFrame([(message(machine_id=i),) for i in (65535, 65536)], "value string")
    limited = messages.parse_messages(sent, machine_ids=(0, 65535)).select("malformed_reason").collect()
    assert [r[0] for r in limited] == [None, "type_invalide"]


def test_single_quotes_are_no_json(spark):
    assert reasons(spark, message().replace('"', "'")) == ["json_invalide"]


def test_times(spark):
    good = {
        "2026-01-15T06:00:00": "2026-01-15T06:00:00",
        "2026-01-15 06:00": "2026-01-15T06:00:00",
        "2026-01-15": "2026-01-15T00:00:00",
        "2026-01-15T06:00:00.250": "2026-01-15T06:00:00.250",
        "2026-01-15T06:00:00+02:00": "2026-01-15T04:00:00",
        "2026-01-15T06:00:00Z": "2026-01-15T06:00:00",
    }
    rows = parsed(spark, *[message(time=t) for t in good])
    assert [r["datetime_mes"] for r in rows] == [at(t) for t in good.values()]
    bad = ["2026", "20260115T060000", "2026-02-30T00:00:00", "pas-une-date", "2026-1-5T06:00:00", ""]
    assert reasons(spark, *[message(time=t) for t in bad]) == ["horodatage_invalide"] * len(bad)


def test_offsets_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = parsed(spark, message(time="2026-01-15T06:00:00+02:00"), message(time="2026-01-15T06:00:00"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["datetime_mes"] for r in rows] == [at("2026-01-15T04:00:00"), at("2026-01-15T06:00:00")]


def test_binary_payloads(spark):
    df = spark.createDataFrame([(bytearray(message().encode()),), (bytearray(b"\xff\xfe{}"),)], "value binary")
    assert sorted(str(r["malformed_reason"]) for r in messages.parse_messages(df).collect()) == ["None", "json_invalide"]


def test_message_round_trip(spark):
    df = spark.createDataFrame([(message(machine_id=7),)], "value string")
    out = messages.to_messages(messages.parse_messages(df)).first()
    assert out["key"] == "7"
    assert json.loads(out["value"]) == {"machine_id": 7, "datetime_mes": "2026-01-15T06:00:00", **READING}
    assert list(json.loads(out["value"])) == list(MESSAGE_FIELDS)


@pytest.mark.parametrize(
    ("topic", "expected"),
    [
        ("usine/capteurs/12/mesure", True),
        ("usine/capteurs/12/13/mesure", False),
        ("usine/capteurs//mesure", False),
        ("usine/capteurs/12/mesures", False),
        ("x/usine/capteurs/12/mesure", False),
    ],
)
def test_topic_filter(spark, topic, expected):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert df.select(messages.topic_matches(F.col("topic"), "usine/capteurs/+/mesure")).first()[0] is expected


def test_kafka_options():
    options = streams.kafka_options("broker:9092", "capteurs", 50000)
    assert options["startingOffsets"] == "earliest"
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("500", "10s")
    assert options["maxOffsetsPerTrigger"] == "50000"
    assert streams.kafka_options("broker:9092", "capteurs")["maxOffsetsPerTrigger"] == str(streams.MAX_OFFSETS)
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("broker:9092", "capteurs", None)
    # What the relay publishes to is what the ingest subscribes to.
    target = streams.kafka_target("broker:9092", "capteurs")
    assert (target["kafka.bootstrap.servers"], target["topic"]) == (options["kafka.bootstrap.servers"], options["subscribe"])


@pytest.mark.parametrize(
    "machine, want",
    [
        ("1.9", 1), ("-0.5", 0), ("7", 7), ('"1.9"', None), ('"7"', 7), ('" +7 "', 7), ('"1_000"', 1000), ('"1__0"', None), ("true", 1),
        ("false", 0), ("null", None), ('""', None), ("[1]", None), ("{}", None), ("1e3", 1000), ("NaN", None), ("Infinity", None),
    ],
)
def test_typed_machine_ids(spark, machine, want):
    text = message().replace('"machine_id": 1', f'"machine_id": {machine}')
    assert machine in text
    (row,) = messages.parse_messages(spark.createDataFrame([(text,)], "value string"), typed=True).collect()
    assert row["malformed_reason"] == (None if want is not None else "type_invalide")
    assert want is None or row["machine_id"] == want


def test_typed_measures_and_structure(spark):
    def read(*texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
        return messages.parse_messages(frame, typed=True).orderBy("i").collect()

    def volt(value):
        return message().replace('"volt": 170.0', f'"volt": {value}')

    assert [r["volt"] for r in read(volt("true"), volt('"1.9"'), volt('" 1e2 "'), volt("12"), volt('"-inf"'), volt('"1_0.5"'))] == [
        1.0, 1.9, 100.0, 12.0, -math.inf, 10.5,
    ]
    assert math.isnan(read(volt("NaN"))[0]["volt"]) and read(volt("-Infinity"))[0]["volt"] == -math.inf
    bad = read(
        volt("null"), volt('"a"'), volt('"0x1p3"'), volt('"1.0d"'), volt("[1]"), '{"machine_id":1}', "[1]", "5", "{", None, message(datetime_mes=5),
        message() + "x", "{'a': 1}",
    )
    assert [r["malformed_reason"] for r in bad] == ["type_invalide"] * 5 + ["champ_manquant"] + ["json_invalide"] * 4 + ["horodatage_invalide"] + ["json_invalide"] * 2


def test_typed_messages_are_parsed_once(spark):
    frame = messages.parse_messages(spark.createDataFrame([(message(),)], "value string"), typed=True).filter("malformed_reason IS NULL")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 2
