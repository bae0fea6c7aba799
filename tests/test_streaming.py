import functools
import random
import time
from pathlib import Path

import pytest
from model import DAY, SIX, exposure_texts, queues
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.operators import interest
from labelloom.plans import labels
from labelloom.schemas import CLICK, LABELS, SEARCH
from labelloom.sources import events_table as ev
from labelloom.sources.logs import file_stream
from labelloom.sources.parse import read_log
from labelloom.shared import work_folder
from labelloom.streaming import jobs
from labelloom.streaming.store import ChangeTable, label_table

T0 = 1_700_000_000_000
CELLS = ["row_key", "label", "value", "write_ts", "expire_ts"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*CELLS).collect()), key=str)


@pytest.fixture(scope="module")
def events_in_files(spark, tmp_path_factory):
    """The events table cut by time into files that arrive one after the other."""
    base = tmp_path_factory.mktemp("events")
    folder = base / "events.parquet"
    folder.mkdir()
    events = ev.read_events(spark, "/root/testdata/sf0.001")
    for i in range(4):
        part = events.where((F.col("event_id") >= 250 * i) & (F.col("event_id") < 250 * (i + 1))).coalesce(1)
        part.toPandas().to_parquet(folder / f"events_{i}.parquet", index=False, coerce_timestamps="us")
    return str(base)


def logs(events):
    return ev.click_log(events), ev.search_log(events), ev.exposure_log(events)


JOBS = {
    "number": (lambda c, s, e: jobs.number_labels(c, s), lambda c, s, e: labels.number_labels(c, s)),
    "last_biz": (lambda c, s, e: jobs.last_biz_labels(c, s, "UTC"), lambda c, s, e: labels.last_biz_labels(c, s, "UTC")),
    "score": (lambda c, s, e: jobs.score_labels(c, s), lambda c, s, e: labels.score_labels(c, s)),
    "exposure": (lambda c, s, e: jobs.exposure_labels(e), lambda c, s, e: labels.exposure_labels(e)),
}


@pytest.mark.parametrize("job", JOBS)
def test_stream_equals_batch_over_several_micro_batches(spark, events_in_files, job):
    stream, batch = JOBS[job]
    source = ev.stream_events(spark, events_in_files, maxFilesPerTrigger="1")
    table = label_table(spark, work_folder(spark))
    query = jobs.run(stream(*logs(source)), table, job, availableNow=True)
    query.awaitTermination(120)
    assert query.exception() is None
    assert table._changes().select("batch").distinct().count() >= 4
    want = rows_of(batch(*logs(ev.read_events(spark, "/root/testdata/sf0.001"))))
    assert rows_of(table.current()) == want
    # Started again with nothing new: the table stays as it is.
    again = jobs.run(stream(*logs(source)), table, job, availableNow=True)
    again.awaitTermination(120)
    assert rows_of(table.current()) == want


def test_all_jobs_share_one_table_and_compaction_keeps_it(spark, events_in_files):
    table = label_table(spark, work_folder(spark))
    for i, (job, (stream, _)) in enumerate(JOBS.items()):
        source = ev.stream_events(spark, events_in_files, maxFilesPerTrigger="2")
        jobs.run(stream(*logs(source)), table, job, availableNow=True).awaitTermination(120)
        if i == 1:
            table.compact()
    want = rows_of(labels.all_labels(*logs(ev.read_events(spark, "/root/testdata/sf0.001")), zone="UTC"))
    assert rows_of(table.current()) == want
    table.compact()
    assert rows_of(table.current()) == want
    version, upto = table._folded()
    assert version == 1 and set(upto) == set(JOBS)
    table.compact()
    assert table._folded() == (version, upto)
    # A newer change wins over the snapshot, a replay of a folded batch does not come back.
    cell = table.current().where("label = 'user_last_biz'").limit(1)
    newer = cell.withColumn("value", F.lit("new")).withColumn("write_ts", F.col("write_ts") + 1)
    table.write("last_biz", newer, upto["last_biz"] + 1)
    assert table.current().where("value = 'new'").count() == 1
    assert table.current().count() == len(want)


def test_replayed_batch_replaces_itself(spark):
    table = label_table(spark, work_folder(spark))
    cell = spark.createDataFrame([("k", "lucky_x", "3", T0, None)], table.schema)
    table.write("number", cell, 0)
    table.write("number", cell.withColumn("value", F.lit("4")), 1)
    table.write("number", cell.withColumn("value", F.lit("4")), 1)
    assert rows_of(table.current()) == [("k", "lucky_x", "4", T0, None)]


MODEL_OF = {b: m for m, b in dims.BIZ_OF_MODEL.items()}


def exposure_row(uid, biz, ts, eid):
    return (uid, MODEL_OF[biz], dims.EXCLUSIVE_STOREY, ts, eid)


def test_exposure_queue_with_pauses_and_late_events(spark, tmp_path):
    """Batches arrive out of order within the lateness; pauses are longer than the gap."""
    rng = random.Random(3)
    gap, table = DAY, label_table(spark, work_folder(spark))
    shown = [
        (f"u{rng.randrange(5)}", rng.choice(SIX), T0 + rng.randrange(12 * DAY // 3_600_000) * 3_600_000, i)
        for i in range(250)
    ]
    shuffled = sorted(shown, key=lambda r: r[2] + rng.randrange(2 * DAY))
    schema = "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint"
    for start in range(0, 250, 50):
        part = [exposure_row(*r) for r in shuffled[start:start + 50]]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        cells = jobs.exposure_labels(source, lateness="3 days", gap_ms=gap)
        query = jobs.run(cells, table, "exposure", availableNow=True)
        query.awaitTermination(120)
        assert query.exception() is None
    trace, _ = queues(shown, gap)
    want = {}
    for uid, _, ts, eid in sorted(shown, key=lambda r: (r[2], r[3])):
        want[uid] = exposure_texts(trace[eid])
    keys = {r["k"]: r["uid"] for r in spark.createDataFrame([(u,) for u in want], "uid string")
            .select("uid", F.md5("uid").alias("k")).collect()}
    got = {}
    for r in table.current().collect():
        got.setdefault(keys[r["row_key"]], {})[r["label"]] = r["value"]
    assert {u: (v["expose_least_biz_7d"], v["expose_biz_his"]) for u, v in got.items()} == want


def test_idle_users_leave_the_state(spark, tmp_path):
    schema = "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint"
    table = label_table(spark, work_folder(spark))
    query = None
    for i, (uid, ts) in enumerate([("idle", T0), ("busy", T0 + 8 * DAY), ("busy", T0 + 9 * DAY)]):
        spark.createDataFrame([exposure_row(uid, "family", ts, i)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = jobs.run(jobs.exposure_labels(source, lateness="1 hour"), table, "exposure", availableNow=True)
        query.awaitTermination(120)
    state = spark.read.format("statestore").option("path", table.checkpoint("exposure")).option(
        "stateVarName", "entries"
    ).load()
    assert {r["key"]["uid"] for r in state.select("key").collect()} == {"busy"}


def test_wall_clock_reset(spark, tmp_path):
    """The state expires by the clock; the pause in the timestamps does not matter."""
    schema = "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint"
    folder, table = str(tmp_path / "in"), label_table(spark, work_folder(spark))

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)

    arrive(exposure_row("u", "family", T0, 0), exposure_row("u", "number", T0 + 30 * DAY, 1))
    source = spark.readStream.schema(schema).parquet(folder)
    cells = jobs.exposure_labels(source, gap_ms=6_000, wall_clock=True)
    query = jobs.run(cells, table, "exposure", processingTime="1 second")
    try:
        def await_history(matches):
            # Such a query always has work to do, so there is no "all processed" to wait for.
            deadline, value = time.time() + 60, None
            while time.time() < deadline and not (value and matches(value)):
                time.sleep(1)
                if list(Path(table.path).glob("changes/*/*/*.parquet")):
                    value = table.current().where("label = 'expose_biz_his'").first()["value"]
            return value

        first = await_history(lambda v: True)
        assert first.startswith("number:1,") and first.endswith("family:1")
        time.sleep(8)
        arrive(exposure_row("u", "package", T0 + 30 * DAY + 1, 2))
        reset = "number:0,xiaomi:0,package:1,broadband:0,terminal:0,family:0"
        assert await_history(lambda v: v == reset) == reset
    finally:
        query.stop()


def test_closed_days_leave_the_state(spark, tmp_path):
    schema = "uid string, biz_type string, pb_name string, num_type string, ts_ms bigint, event_id bigint"
    empty = "search_mob string, biz_type string, number_type string, ts_ms bigint, event_id bigint"
    spark.createDataFrame([], empty).write.parquet(str(tmp_path / "searches"))
    table = label_table(spark, work_folder(spark))
    progress = None
    for i, ts in enumerate([T0, T0 + DAY, T0 + 9 * DAY]):
        row = [("u", "familyModel", None, None, ts, i)]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "clicks"))
        clicks = spark.readStream.schema(schema).parquet(str(tmp_path / "clicks"))
        # The same log on both sides, so both watermarks move; nothing is taken from the second one.
        searches = clicks.select(
            F.col("uid").alias("search_mob"), F.lit(None).cast("string").alias("biz_type"), "ts_ms", "event_id"
        )
        query = jobs.run(jobs.score_labels(clicks, searches, "1 hour"), table, "score", availableNow=True)
        query.awaitTermination(120)
        progress = query.lastProgress
    assert progress["stateOperators"][0]["numRowsTotal"] == 2
    values = {r["label"]: r["value"] for r in table.current().collect()}
    assert values["biz_click"] == "0,0,0,0,1"


def test_json_lines_from_files_to_labels(spark, tmp_path):
    """The whole way: raw lines that arrive as text files, parsed, counted, read back."""
    good = '{"uid":"u1","biz_type":"cardModel","pb_name":"点击号码","num_type":"03","ts":%d}'
    (tmp_path / "clicks").mkdir()
    (tmp_path / "searches").mkdir()
    (tmp_path / "clicks" / "a.json").write_text("\n".join([good % T0, "broken", good % (T0 + 1)]), encoding="utf-8")
    (tmp_path / "searches" / "a.json").write_text(
        '{"search_mob":"u1","biz_type":"number","number_type":"lucky","ts":"%d"}' % T0, encoding="utf-8"
    )
    clicks = read_log(file_stream(spark, str(tmp_path / "clicks")), CLICK)
    searches = read_log(file_stream(spark, str(tmp_path / "searches")), SEARCH)
    table = label_table(spark, work_folder(spark))
    jobs.run(jobs.number_labels(clicks, searches), table, "number", availableNow=True).awaitTermination(120)
    assert [(r["label"], r["value"]) for r in table.current().orderBy("label").collect()] == [
        ("lucky_clicks", "2"), ("lucky_searchs", "1"),
    ]


def test_sink_errors_fail_the_query(spark, events_in_files):
    table = label_table(spark, work_folder(spark))

    def broken(job, changed, batch_id):
        raise RuntimeError("sink is down")

    table.write = broken
    source = ev.stream_events(spark, events_in_files)
    query = jobs.run(jobs.number_labels(*logs(source)[:2]), table, "number", availableNow=True)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination(120)


def test_work_folder_uses_the_shared_checkpoint_folder(spark):
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/labelloom-")


def test_work_folder_is_never_local_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Cluster)


def test_file_and_folder_give_the_same_stream(spark, events_in_files):
    for base in (events_in_files, "/root/testdata/sf0.001"):
        table = label_table(spark, work_folder(spark))
        jobs.run(jobs.number_labels(*logs(ev.stream_events(spark, base))[:2]), table, "n", availableNow=True).awaitTermination(120)
        want = rows_of(labels.number_labels(*logs(ev.read_events(spark, "/root/testdata/sf0.001"))[:2]))
        assert rows_of(table.current()) == want and want


def test_table_before_the_first_batch(spark):
    table = label_table(spark, work_folder(spark))
    assert table.current().count() == 0
    table.compact()
    assert table.current().count() == 0


def cells_of(spark, *keys, value="v", write_ts=1, expire_ts=None):
    return spark.createDataFrame([(k, "l", value, write_ts, expire_ts) for k in keys], LABELS)


def unfinish(table, job, batch):
    """Leaves a batch as a failed job does: some of its files, and no mark."""
    folder = Path(table.path) / "changes" / f"job={job}" / f"batch={batch}"
    for mark in folder.glob("*SUCCESS*"):
        mark.unlink()


def test_a_half_written_batch_in_the_middle_is_not_folded(spark):
    table = label_table(spark, work_folder(spark))
    table.write("job", cells_of(spark, "a"), 0)
    table.write("job", cells_of(spark, "b"), 1)
    unfinish(table, "job", 1)
    table.write("job", cells_of(spark, "c"), 2)
    table.write("other", cells_of(spark, "d"), 7)
    table.compact()
    # Batch 2 waits for batch 1; a job may begin at any number.
    assert table._folded() == (0, {"job": 0, "other": 7})
    table.write("job", cells_of(spark, "b", "e"), 1)
    assert sorted(r.row_key for r in table.current().collect()) == ["a", "b", "c", "d", "e"]
    table.compact()
    assert table._folded() == (1, {"job": 2, "other": 7})
    assert sorted(r.row_key for r in table.current().collect()) == ["a", "b", "c", "d", "e"]
    table.compact()
    assert table._folded()[0] == 1  # nothing new, nothing done


def test_an_unfinished_first_batch_holds_back_the_others(spark):
    table = label_table(spark, work_folder(spark))
    for batch, key in enumerate("abc"):
        table.write("job", cells_of(spark, key), batch)
    unfinish(table, "job", 0)
    table.compact()
    assert table._folded() == (None, {}) and table.current().count() == 3


def test_two_hundred_batches_leave_few_files(spark):
    table = ChangeTable(spark, work_folder(spark), LABELS, ["row_key", "label"], order=("write_ts",), buckets=2)
    counts = []
    for batch in range(200):
        table.write("job", cells_of(spark, f"k{batch % 30}", f"n{batch}", value=str(batch), write_ts=batch, expire_ts=batch + 40), batch)
        if batch % 10 == 9:
            table.compact(now_ms=batch)
            counts.append(sum(1 for _ in Path(table.path).rglob("*.parquet")))
    assert max(counts[3:]) <= 40 and counts[-1] <= counts[4] + 5
    rows = {r.row_key: r.value for r in table.current().collect()}
    # Expired cells are gone from the disk, not only hidden.
    assert set(rows) == {f"n{b}" for b in range(160, 200)} | {f"k{b % 30}" for b in range(160, 200)}
    assert all(rows[f"k{b % 30}"] == str(b) for b in range(170, 200))


def test_a_reader_that_began_before_compact_finishes(spark):
    table = label_table(spark, work_folder(spark))
    for batch in range(6):
        table.write("job", cells_of(spark, f"k{batch}", "same", value=str(batch), write_ts=batch), batch)
        if batch % 2:
            table.compact()
    reader = table.current()
    table.write("job", cells_of(spark, "later"), 6)
    table.compact()
    assert sorted(r.row_key for r in reader.collect()) == ["k0", "k1", "k2", "k3", "k4", "k5", "same"]
    assert table.current().count() == 8
    assert {r.value for r in table.current().where("row_key = 'same'").collect()} == {"5"}


def test_a_batch_is_a_few_files_whatever_the_shuffle(spark):
    table = label_table(spark, work_folder(spark))
    table.write("job", spark.range(1_000).selectExpr("string(id) AS row_key", "'l' AS label", "'v' AS value", "1L AS write_ts", "CAST(NULL AS bigint) AS expire_ts").repartition(60), 0)
    assert len(list(Path(table.path).glob("changes/job=job/batch=0/*.parquet"))) <= 2
    assert table.current().count() == 1_000


def test_a_job_may_fold_its_table(spark, events_in_files):
    table = label_table(spark, work_folder(spark))
    source = ev.stream_events(spark, events_in_files, maxFilesPerTrigger="1")
    jobs.run(jobs.number_labels(*logs(source)[:2]), table, "number", compact_every=2, availableNow=True).awaitTermination(120)
    assert table._folded()[0] >= 1
    assert rows_of(table.current()) == rows_of(labels.number_labels(*logs(ev.read_events(spark, "/root/testdata/sf0.001"))[:2]))


def exposed(spark, folder, batches):
    """An exposure stream that reads one batch of (uid, biz_type, ts) after the other."""
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame([(u, b, "首页-专享", ts, 10 * i + j) for j, (u, b, ts) in enumerate(rows)],
                                      "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint")
        frame.coalesce(1).write.mode("append").parquet(folder)
        yield frame


def test_late_exposures_and_wrong_clocks_lose_nothing(spark, tmp_path):
    folder, day = str(tmp_path / "in"), 86_400_000
    ahead = int(time.time() * 1000) + 1_000 * day
    recent = int(time.time() * 1000) - 5 * day
    batches = [
        [("u", "familyModel", recent)], [("v", "cardModel", recent + 3 * day), ("w", "cardModel", ahead)],
        [("u", "cardModel", recent + 1 * day)], [("v", "familyModel", recent + 3 * day + 1)],
    ]
    frames = list(exposed(spark, folder, batches))
    source = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", "1").parquet(folder)
    table = label_table(spark, work_folder(spark))
    jobs.run(jobs.exposure_labels(source), table, "exposure", availableNow=True).awaitTermination(120)
    want = rows_of(labels.exposure_labels(functools.reduce(lambda a, b: a.union(b), frames)))
    assert rows_of(table.current()) == want


def test_ttl_may_count_from_the_clock(spark, events_in_files):
    source = ev.stream_events(spark, events_in_files)
    table = label_table(spark, work_folder(spark))
    before = int(time.time() * 1000)
    changed = jobs.last_biz_labels(*logs(source)[:2], "UTC")
    jobs.run(changed, table, "last_biz", ttl_from_clock=True, availableNow=True).awaitTermination(120)
    rows = table.current().collect()
    assert rows and all(before <= r["expire_ts"] - dims.LAST_BIZ_TTL_MS <= time.time() * 1000 for r in rows)
    assert labels.visible(table.current(), before).count() == len(rows)


def test_exposures_of_any_age_find_their_queue(spark, tmp_path):
    """A user's event of day 1 arrives behind another user's of day 9, and one behind a pause of all."""
    folder = str(tmp_path / "in")
    batches = [
        [("u", "familyModel", T0), ("u", "cardModel", T0 + 6 * DAY)], [("v", "cardModel", T0 + 9 * DAY)],
        [("w", "cardModel", T0 + 9 * DAY + 1)], [("u", "packageModel", T0 + DAY)],
        [("v", "cardModel", T0 + 40 * DAY)], [("w", "familyModel", T0 + 41 * DAY)], [("u", "terminalModel", T0 + 2 * DAY)],
    ]
    frames = list(exposed(spark, folder, batches))
    source = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", "1").parquet(folder)
    table = label_table(spark, work_folder(spark))
    jobs.run(jobs.exposure_labels(source), table, "exposure", availableNow=True).awaitTermination(120)
    assert rows_of(table.current()) == rows_of(labels.exposure_labels(functools.reduce(lambda a, b: a.union(b), frames)))


def clicked(spark, folder, batches):
    """A click stream that reads one batch of (uid, ts) after the other, and the same clicks as a frame."""
    schema = "uid string, biz_type string, pb_name string, num_type string, ts_ms bigint, event_id bigint"
    frames = []
    for i, rows in enumerate(batches):
        rows = [(u, "familyModel", None, None, ts, 10 * i + j) for j, (u, ts) in enumerate(rows)]
        frames.append(spark.createDataFrame(rows, schema))
        frames[-1].coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    return source, functools.reduce(lambda a, b: a.union(b), frames)


def searched(clicks):
    return clicks.select(F.col("uid").alias("search_mob"), F.lit("number").alias("biz_type"), "ts_ms", "event_id")


def daily_table(spark, changed):
    return ChangeTable(spark, work_folder(spark), changed.schema, ["uid", "day", "channel", "biz"])


def test_counts_and_scores_of_rows_far_behind(spark, tmp_path):
    late = [[("u", T0)], [("v", T0 + 30 * DAY)], [("v", T0 + 31 * DAY)], [("u", T0 + 1)], [("w", T0 - DAY)]]
    stream, batch = clicked(spark, str(tmp_path / "in"), late)
    changed = jobs.daily_counts(stream, searched(stream))
    table = daily_table(spark, changed)
    jobs.run(changed, table, "daily", availableNow=True).awaitTermination(120)
    want = interest.daily_counts(labels.scored_actions(batch, searched(batch)))
    assert sorted(map(tuple, table.current().collect())) == sorted(map(tuple, want.collect()))
    table = label_table(spark, work_folder(spark))
    jobs.run(jobs.score_labels(stream, searched(stream)), table, "score", availableNow=True).awaitTermination(120)
    assert rows_of(table.current()) == rows_of(labels.score_labels(batch, searched(batch)))


@pytest.mark.parametrize("lateness", [None, "3 days"])
def test_a_stamp_ahead_counts_on_its_own_day(spark, tmp_path, lateness):
    now = int(time.time() * 1000)
    batches = [[("u", now - DAY), ("u", now + 5 * DAY), ("v", now)], [("u", now), ("v", now + DAY)], [("v", now + DAY + 1)]]
    stream, batch = clicked(spark, str(tmp_path / "in"), batches)
    table = label_table(spark, work_folder(spark))
    jobs.run(jobs.score_labels(stream, searched(stream), lateness), table, "score", availableNow=True).awaitTermination(120)
    assert rows_of(table.current()) == rows_of(labels.score_labels(batch, searched(batch)))
    changed = jobs.daily_counts(stream, searched(stream), lateness)
    table = daily_table(spark, changed)
    jobs.run(changed, table, "daily", availableNow=True).awaitTermination(120)
    want = interest.daily_counts(labels.scored_actions(batch, searched(batch)))
    assert sorted(map(tuple, table.current().collect())) == sorted(map(tuple, want.collect()))
