import pytest
from pyspark.sql import functions as F

from labelloom.schemas import CLICK, EXPOSURE, SEARCH
from labelloom.sources.logs import file_backfill, kafka_options
from labelloom.sources.parse import parse, read_log, rejects

T0 = 1_700_000_000_000


def raw(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, event_id bigint")


@pytest.mark.parametrize("value, reason", [
    ("bad", "malformed"),
    ("{bad", "malformed"),
    ("[]", "malformed"),
    ('[{"uid":"u1","ts":1}]', "malformed"),
    ("", "malformed"),
    ("   ", "malformed"),
    (None, "malformed"),
    ("null", "malformed"),
    ('"text"', "malformed"),
    ("{}", "no_user"),
    ('{"ts":1}', "no_user"),
    ('{"uid":null,"ts":1}', "no_user"),
    ('{"uid":"u1"}', "bad_ts"),
    ('{"uid":"u1","ts":"xx"}', "bad_ts"),
    ('{"uid":"u1","ts":1e30}', "bad_ts"),
    ('{"uid":"u1","ts":null}', "bad_ts"),
])
def test_rejects(spark, value, reason):
    parsed = parse(raw(spark, value), CLICK)
    assert [tuple(r) for r in rejects(parsed, CLICK).collect()] == [("click", reason, value)]
    assert read_log(raw(spark, value), CLICK).count() == 0


@pytest.mark.parametrize("value, uid, ts", [
    ('{"uid":"u1","ts":1700000000000}', "u1", T0),
    ('{"uid":5,"ts":"1700000000000"}', "5", T0),
    ('{"uid":true,"ts":1700000000000,"extra":[1]}', "true", T0),
    ("{uid:'u1',ts:1700000000000}", "u1", T0),
    ('{"uid":"","ts":1700000000000}', "", T0),
])
def test_accepted(spark, value, uid, ts):
    row = read_log(raw(spark, value), CLICK).first()
    assert (row["uid"], row["ts_ms"]) == (uid, ts)


def test_every_line_is_either_accepted_or_rejected(spark):
    lines = raw(spark, '{"search_mob":"u","ts":1}', "x", '{"search_mob":"u"}', '{"search_mob":"u","ts":"2"}')
    parsed = parse(lines, SEARCH)
    assert parsed.where("reject is null").count() == 2
    assert rejects(parsed, SEARCH).count() == 2


def test_all_fields_arrive_as_text(spark):
    row = read_log(raw(spark, '{"uid":1,"biz_type":"familyModel","storey":"首页-专享","ts":"3"}'), EXPOSURE).first()
    assert row.asDict() == {"uid": "1", "biz_type": "familyModel", "storey": "首页-专享", "ts_ms": 3, "event_id": 0}


def test_each_line_is_parsed_once(spark):
    plan = read_log(raw(spark, "{}"), CLICK).select("uid")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_text_and_table_backfill(spark, tmp_path):
    lines = ['{"uid":"a","ts":1}', '{"uid":"b","ts":2}']
    (tmp_path / "log.json").write_text("\n".join(lines))
    assert sorted(r["uid"] for r in read_log(file_backfill(spark, str(tmp_path)), CLICK).collect()) == ["a", "b"]
    raw(spark, *lines).write.parquet(str(tmp_path / "table"))
    rows = read_log(file_backfill(spark, str(tmp_path / "table"), "parquet"), CLICK).collect()
    assert sorted((r["uid"], r["event_id"]) for r in rows) == [("a", 0), ("b", 1)]


def test_kafka_options():
    options = kafka_options(
        "host:9092", "clicks", security_protocol="SASL_PLAINTEXT", sasl_mechanism="PLAIN",
        sasl_jaas_config="jaas", maxOffsetsPerTrigger="1000",
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "clicks",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "jaas",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_options("h", "t") == {"kafka.bootstrap.servers": "h", "subscribe": "t"}


def test_kafka_rows_get_a_unique_order(spark):
    from labelloom.sources.logs import _kafka_columns

    records = [(b"x", 0, 7), (b"y", 1, 7), (b"z", 0, 8)]
    rows = spark.createDataFrame(records, "value binary, partition int, offset bigint")
    got = _kafka_columns(rows).orderBy("event_id").collect()
    assert [r["value"] for r in got] == ["x", "y", "z"]
    assert len({r["event_id"] for r in got}) == 3
    assert _kafka_columns(rows).where(F.col("event_id") < 0).count() == 0


@pytest.mark.parametrize("ts", ["1700000000000", "1.7e12", "1700000000000.0", "1700000000000.9", '"1700000000000"'])
def test_any_number_is_a_timestamp_by_its_whole_part(spark, ts):
    rows = read_log(raw(spark, '{"uid":"u1","ts":%s}' % ts), CLICK).collect()
    assert [r["ts_ms"] for r in rows] == [1_700_000_000_000]
