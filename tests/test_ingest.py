import pytest

from labelloom.schemas import CLICK
from labelloom.sources.ingest import ingest, ingest_stream, read_ingested, read_rejects
from labelloom.sources.logs import file_stream

LINES = ['{"uid":"a","biz_type":"cardModel","ts":1}', "broken", '{"uid":"b","ts":"2"}', '{"ts":3}']


def check(spark, path):
    assert sorted((r["uid"], r["ts_ms"]) for r in read_ingested(spark, CLICK, path).collect()) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, read_rejects(spark, CLICK, path).collect())) == [
        ("click", "malformed", "broken"), ("click", "no_user", '{"ts":3}'),
    ]
    plan = read_ingested(spark, CLICK, path).select("uid")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reject" in plan and "ReadSchema: struct<uid:string>" in plan


def test_batch(spark, tmp_path):
    raw = spark.createDataFrame(list(zip(LINES, range(4))), "value string, event_id bigint")
    for _ in range(2):  # a batch that is stored again replaces itself
        ingest(raw, CLICK, str(tmp_path))
        check(spark, str(tmp_path))
    ingest(raw, CLICK, str(tmp_path), batch="next")
    assert read_ingested(spark, CLICK, str(tmp_path)).count() == 4


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES))
    for _ in range(2):  # the second run finds nothing new
        query = ingest_stream(file_stream(spark, str(tmp_path / "in")), CLICK, str(tmp_path / "out"), availableNow=True)
        query.awaitTermination(60)
    check(spark, str(tmp_path / "out"))


def test_unknown_options_are_not_swallowed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(TypeError):
        ingest_stream(file_stream(spark, str(tmp_path / "in")), CLICK, str(tmp_path / "out"), nonsense=1)
