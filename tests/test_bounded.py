"""Streams with bounded state: late rows change their labels, closed days and idle users leave the state."""

import random
import time

import pytest
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.operators import interest
from labelloom.plans import labels
from labelloom.shared import work_folder
from labelloom.streaming import bounded, jobs
from labelloom.streaming.store import ChangeTable, label_table

DAY, HOUR = dims.DAY_MS, 3_600_000
T0 = 1_700_000_000_000
CLICKS = "uid string, biz_type string, pb_name string, num_type string, ts_ms bigint, event_id bigint"
EXPOSURES = "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint"
MODELS = list(dims.BIZ_OF_MODEL)
CELLS = ["row_key", "label", "value", "write_ts", "expire_ts"]


def rows_of(df, columns=CELLS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def searched(clicks):
    return clicks.select(F.col("uid").alias("search_mob"), F.lit("number").alias("biz_type"), (F.col("ts_ms") + 7).alias("ts_ms"), "event_id")


def click(uid, ts, eid, biz="familyModel"):
    return uid, biz, None, None, ts, eid


def shown(uid, ts, eid, biz="familyModel"):
    return uid, biz, dims.EXCLUSIVE_STOREY, ts, eid


class Feed:
    """Batches of rows, each with the time its clock shows; the job runs to the end of each."""

    def __init__(self, spark, folder, schema, start):
        self.spark, self.folder, self.schema, self.start, self.rows = spark, str(folder), schema, start, []

    def arrive(self, clock, rows):
        self.rows += rows
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        source = self.spark.readStream.schema(self.schema).parquet(self.folder)
        query = self.start(source, int(time.time() * 1000) - clock)
        query.awaitTermination(120)
        assert query.exception() is None
        return [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]] if query.lastProgress else []

    def batch(self):
        return self.spark.createDataFrame(self.rows, self.schema)


def score_feed(spark, tmp_path, lateness):
    table, folder = label_table(spark, work_folder(spark)), work_folder(spark)

    def start(source, behind):
        rows = bounded.score_rows(source, searched(source), lateness, behind)
        return jobs.run(rows, table, "score", cells=bounded.score_cells(bounded.Ledger(spark, folder, rows.schema)), availableNow=True)

    return table, Feed(spark, tmp_path / "in", CLICKS, start)


def test_late_rows_beyond_the_limit_change_their_scores(spark, tmp_path):
    table, feed = score_feed(spark, tmp_path, 2 * DAY)
    feed.arrive(T0 + DAY, [click("u", T0, 0), click("v", T0, 1, "cardModel"), click("w", T0 + HOUR, 2)])
    feed.arrive(T0 + 20 * DAY, [click("v", T0 + 20 * DAY - HOUR, 3), click("x", T0 + 19 * DAY, 4)])
    # Late for its own label, late for the day before, older than everything, and on time.
    feed.arrive(T0 + 21 * DAY, [
        click("u", T0 + 1, 5, "packageModel"), click("w", T0 - 20 * HOUR, 6), click("v", T0 - 9 * DAY, 7), click("x", T0 + 21 * DAY - 1, 8), click("new", T0 + 3, 9),
    ])
    # A day whose first half is late and whose second is on time.
    feed.arrive(T0 + 22 * DAY, [click("x", T0 + 20 * DAY - HOUR, 10), click("x", T0 + 20 * DAY + HOUR, 11), click("x", T0 + 22 * DAY - 5, 12)])
    feed.arrive(T0 + 23 * DAY, [click("x", T0 + 22 * DAY + 1, 13), click("v", T0 + 19 * DAY, 14)])
    batch = feed.batch()
    assert rows_of(table.current()) == rows_of(labels.score_labels(batch, searched(batch)))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_arrival_equals_the_batch_form(spark, tmp_path, seed):
    rng = random.Random(seed)
    table, feed = score_feed(spark, tmp_path, 3 * DAY)
    eid = 0
    for step in range(5):
        clock, rows = T0 + step * 2 * DAY, []
        for _ in range(60):
            age = rng.choice([0, HOUR, DAY, 2 * DAY, 3 * DAY, 4 * DAY, 9 * DAY]) + rng.randrange(DAY // 3)
            rows.append(click(f"u{rng.randrange(12)}", clock - age, eid, rng.choice(MODELS)))
            eid += 1
        feed.arrive(clock, rows)
    batch = feed.batch()
    assert rows_of(table.current()) == rows_of(labels.score_labels(batch, searched(batch)))


def test_score_state_stays_bounded(spark, tmp_path):
    """Sixty days in steps of six: the state holds no more than the open days."""
    table, feed = score_feed(spark, tmp_path, 2 * DAY)
    held, eid = [], 0
    for step in range(10):
        clock = T0 + step * 6 * DAY
        rows = [click(f"u{u}", clock - d * DAY - u, eid + 10 * u + d) for u in range(8) for d in range(6)]
        eid += 1_000
        held.append(feed.arrive(clock, rows)[0])
    batch = feed.batch()
    # Eight users, the open days and the one ahead; without a bound there would be 480 and more.
    assert max(held) <= 8 * 10 and held[-1] <= held[2]
    assert rows_of(table.current()) == rows_of(labels.score_labels(batch, searched(batch)))


def test_daily_counts(spark, tmp_path):
    keys, folder, tables = ["uid", "day", "channel", "biz"], work_folder(spark), []

    def start(source, behind):
        rows = bounded.count_rows(source, searched(source), 2 * DAY, behind)
        tables or tables.append(ChangeTable(spark, work_folder(spark), rows.drop("late").schema, keys))
        return jobs.run(rows, tables[0], "daily", cells=bounded.count_cells(bounded.Ledger(spark, folder, rows.schema)), availableNow=True)

    feed = Feed(spark, tmp_path / "in", CLICKS, start)
    feed.arrive(T0, [click("u", T0 - 1, 0), click("u", T0 - 2, 1, "otherModel"), click("u", T0 - 9 * DAY, 2)])
    feed.arrive(T0 + 9 * DAY, [click("u", T0 - 3, 3), click("u", T0 - 4, 4, "otherModel"), click("v", T0 + 9 * DAY, 5)])
    feed.arrive(T0 + 10 * DAY, [click("u", T0 - 9 * DAY, 6), click("v", T0 + 9 * DAY, 7), click("v", T0 + 30 * DAY, 8)])
    batch = feed.batch()
    want = interest.daily_counts(labels.scored_actions(batch, searched(batch)))
    assert rows_of(tables[0].current(), [*keys, "n"]) == rows_of(want, [*keys, "n"])


def exposure_feed(spark, tmp_path, lateness, gap):
    table, folder = label_table(spark, work_folder(spark)), work_folder(spark)

    def start(source, behind):
        rows = bounded.exposure_rows(source, lateness, behind, gap_ms=gap)
        ledger = bounded.Ledger(spark, folder, rows.schema)
        return jobs.run(rows, table, "exposure", cells=bounded.exposure_cells(ledger, gap_ms=gap), availableNow=True)

    return table, Feed(spark, tmp_path / "in", EXPOSURES, start)


def exposed(feed, gap):
    from labelloom.operators import classify, exposure

    counts = exposure.latest_counts(classify.exclusive_exposures(feed.batch()), gap_ms=gap)
    return rows_of(labels.exposure_cells(labels.exposure_texts(counts)))


def test_a_late_exposure_finds_a_queue_that_left_the_state(spark, tmp_path):
    gap = 7 * DAY
    table, feed = exposure_feed(spark, tmp_path, DAY, gap)
    feed.arrive(T0, [shown("u", T0, 0), shown("v", T0 - 5, 1, "cardModel"), shown("w", T0, 2)])
    feed.arrive(T0 + 10 * DAY, [shown("v", T0 + 10 * DAY, 3), shown("x", T0 + 10 * DAY, 4)])
    held = feed.arrive(T0 + 11 * DAY, [shown("x", T0 + 11 * DAY, 5)])
    # Late: behind a queue that has left, and into a pause, which it closes.
    feed.arrive(T0 + 12 * DAY, [shown("u", T0 + 2 * DAY, 6, "packageModel"), shown("v", T0 + 5 * DAY, 7, "terminalModel"), shown("y", T0, 8)])
    feed.arrive(T0 + 13 * DAY, [shown("v", T0 + 13 * DAY, 9), shown("v", T0 + 13 * DAY, 10, "xiaomiModel")])
    assert rows_of(table.current()) == exposed(feed, gap)
    assert held and held[0] <= 6  # u and w are gone


@pytest.mark.parametrize("seed", [3, 4])
def test_random_exposures_equal_the_batch_form(spark, tmp_path, seed):
    rng = random.Random(seed)
    gap = 2 * DAY
    table, feed = exposure_feed(spark, tmp_path, DAY, gap)
    eid = 0
    for step in range(4):
        clock, rows = T0 + step * 2 * DAY, []
        for _ in range(90):
            age = rng.choice([0, HOUR, DAY, 2 * DAY, 5 * DAY]) + rng.randrange(DAY // 4)
            rows.append(shown(f"u{rng.randrange(9)}", clock - age, eid, rng.choice(MODELS)))
            eid += 1
        feed.arrive(clock, rows)
    assert rows_of(table.current()) == exposed(feed, gap)


def test_newest_rows_keep_their_ids(spark):
    """The trim before the state: large ids next to null ones, ties in time."""
    import pyarrow as pa

    from labelloom.streaming.queue_state import _in_order, keep_newest

    ids = [2**60 + 1, 2**60 + 3, None, 2**60 + 2, None]
    batch = pa.RecordBatch.from_pydict({
        "uid": ["a"] * 5 + ["b"], "biz": list("vwxyz") + ["q"], "ts_ms": pa.array([5, 5, 5, 5, 4, 1]), "event_id": pa.array([*ids, 7], pa.int64()),
    })
    kept = [r for out in keep_newest(2)(iter([batch, batch.slice(0, 0)])) for r in out.to_pylist()]
    assert [(r["uid"], r["event_id"]) for r in kept] == [("a", 2**60 + 3), ("a", 2**60 + 2), ("b", 7)]
    assert sorted([(5, None, "x"), (5, 3, "y"), (4, 9, "z")], key=_in_order) == [(4, 9, "z"), (5, None, "x"), (5, 3, "y")]
