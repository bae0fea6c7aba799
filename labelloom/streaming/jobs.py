"""Label jobs over streaming logs.

Each job is a streaming DataFrame of label rows in update mode: one row per touched key and
micro-batch, with the value that key has now. ``run`` writes them to the label table.

The state of these jobs waits for late events for ever, or, with a ``lateness``, drops what comes later than that
against the newest event of the log; only Spark's numRowsDroppedByWatermark tells. Jobs that bound their
state and lose nothing are in ``streaming.bounded``; ``run`` takes their rows with ``cells``.
"""

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from labelloom import dims
from labelloom.functions.calendar import day_number, day_window
from labelloom.functions.text import counts_text, row_key
from labelloom.operators import classify, exposure, interest
from labelloom.plans import labels
from labelloom.sources.parse import with_event_time
from labelloom.streaming import queue_state
from labelloom.streaming.store import ChangeTable

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def number_labels(clicks: DataFrame, searches: DataFrame) -> DataFrame:
    """Counters never expire, so neither does their state: no watermark, nothing is ever late."""
    return labels.number_labels(clicks, searches)


def last_biz_labels(clicks: DataFrame, searches: DataFrame, zone: str | None = None) -> DataFrame:
    return labels.last_biz_labels(clicks, searches, zone)


def _timed_actions(clicks: DataFrame, searches: DataFrame, lateness: str | None) -> DataFrame:
    if lateness is None:
        return labels.scored_actions(clicks, searches).withColumn("event_time", F.timestamp_millis("ts_ms"))
    # One watermark per log; Spark goes by the slower one. A log that has gone silent holds the state
    # of both back (spark.sql.streaming.multipleWatermarkPolicy decides).
    timed = labels.scored_actions(with_event_time(clicks, lateness), with_event_time(searches, lateness))
    return timed.select(*[_logged_time(timed) if c == "event_time" else c for c in timed.columns])


def _logged_time(timed: DataFrame) -> Column:
    """The time as logged in place of ``event_time``, which is cut to now for the watermark: a row counts on
    its own day. The mark of the watermark goes over to it, so the days still leave the state."""
    mark = timed.schema["event_time"].metadata
    return F.timestamp_millis("ts_ms").alias("event_time", metadata=mark)


def daily_counts(
    clicks: DataFrame, searches: DataFrame, lateness: str | None = None, offset_ms: int = dims.DAY_OFFSET_MS
) -> DataFrame:
    """``uid, day, channel, biz, n`` per calendar day; with a ``lateness`` a day's state goes when the day is closed."""
    actions = _timed_actions(clicks, searches, lateness)
    counts = actions.groupBy("uid", day_window("event_time", 1, offset_ms), "channel", "biz").agg(
        F.count("*").alias("n")
    )
    day = day_number("unix_millis(window.start)", offset_ms)
    return counts.selectExpr("uid", f"{day} AS day", "channel", "biz", "n")


def score_labels(
    clicks: DataFrame,
    searches: DataFrame,
    lateness: str | None = None,
    offset_ms: int = dims.DAY_OFFSET_MS,
    on_flat: str = "nan",
) -> DataFrame:
    """Two-day scores from a sliding window of two calendar days.

    The window that ends with day d holds exactly the counts of d-1 and d, so yesterday needs no
    lookup. A window speaks for its user once it has an event on its last day. State is native
    and leaves with the watermark, if ``lateness`` sets one.
    """
    windows = _timed_actions(clicks, searches, lateness).groupBy(
        "uid", day_window("event_time", 2, offset_ms)
    ).agg(*interest.aggregates(interest.HIT_SUMS + interest.LAST_SEEN))
    last_day_ms = f"unix_millis(window.end) - {dims.DAY_MS}L"
    speaking = windows.where(f"greatest(last_click_ts, last_search_ts) >= {last_day_ms}")
    own = [
        f"if(last_{ch}_ts >= {last_day_ms}, {counts_text(names)}, NULL) AS biz_{ch}"
        for ch, names in zip(dims.CHANNELS, (interest.CLICK_COUNTS, interest.SEARCH_COUNTS))
    ]
    flat = speaking.selectExpr(f"{row_key()} AS row_key", "last_click_ts", "last_search_ts", *own, *interest.COUNTS)
    return labels.score_cells(interest.with_scores(interest.with_raw_scores(flat), on_flat))


def exposure_labels(
    exposures: DataFrame,
    lateness: str | None = None,
    length: int = dims.QUEUE_LENGTH,
    gap_ms: int = dims.IDLE_GAP_MS,
    pad_below: int = dims.PAD_BELOW,
    wall_clock: bool = False,
) -> DataFrame:
    """Labels of the last exposures. Without a ``lateness`` a queue is never forgotten: twelve entries for
    each user, who may come back with events of any age. ``wall_clock`` resets a queue when nothing arrives for ``gap_ms``,
    whatever the timestamps say; then there is no watermark and no event is ever late. Such a query
    keeps checking its clock: it runs until it is stopped, ``availableNow`` does not end it."""
    shown = classify.exclusive_exposures(exposures.drop("event_time"))
    trimmed = shown.select("uid", "biz", "ts_ms", "event_id").mapInArrow(
        queue_state.keep_newest(length), queue_state.TRIMMED
    )
    bounded = lateness is not None and not wall_clock
    timed = with_event_time(trimmed, lateness) if bounded else trimmed
    queues = timed.groupBy("uid").transformWithState(
        queue_state.LastExposures(length, gap_ms, wall_clock, forgets=bounded),
        queue_state.OUTPUT,
        outputMode="Update",
        timeMode="ProcessingTime" if wall_clock else "EventTime" if bounded else "None",
    )
    counts = queues.selectExpr("uid", "last_ts", *exposure.counts_of_array("queue"))
    return labels.exposure_cells(labels.exposure_texts(counts, pad_below))


@contextmanager
def _state_store(spark: SparkSession):
    """RocksDB state with changelog checkpoints; a query keeps the settings it was started with."""
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run(
    changed: DataFrame, table: ChangeTable, job: str, ttl_from_clock: bool = False,
    cells: Callable[[DataFrame, int], DataFrame] | None = None, compact_every: int | None = None, **trigger,
) -> StreamingQuery:
    """Starts a job. A sink error fails the micro-batch, which is then replayed into its folder.

    With ``ttl_from_clock`` labels live from the moment they are written, so those of a stream that lags
    behind can be read; else they live from their event, as in a backfill.

    With ``compact_every`` the table is folded after every so many batches; only one job of a table may do that.

    ``cells`` makes label rows of a micro-batch, for streams that do not hold them yet (see ``bounded``).

    ``trigger`` is passed to Spark, e.g. ``processingTime="10 seconds"`` or ``availableNow=True``.
    The number of state partitions is ``spark.sql.shuffle.partitions`` of the first start.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if cells is not None:
            rows = cells(rows, batch_id)
        table.write(job, labels.living_from(rows, int(time.time() * 1000)) if ttl_from_clock else rows, batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            table.compact(int(time.time() * 1000))

    writer = (
        changed.writeStream.queryName(job)
        .outputMode("update")
        .option("checkpointLocation", table.checkpoint(job))
        .foreachBatch(write)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return started(writer, changed.sparkSession)


def started(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Starts a query with the state store of all jobs here."""
    with _state_store(spark):
        return writer.start()
