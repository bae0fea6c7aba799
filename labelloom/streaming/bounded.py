"""Label jobs whose state is bounded and which lose no row all the same.

Rows are told apart by the clock of their micro-batch, which Spark stores with the batch, so a replay tells
them apart alike. A row at most ``lateness`` old is on time: it goes through state that the watermark clears. The
watermark trails the clock by the same ``lateness``, hence Spark never drops a row that is on time. Older
rows are late. They touch no state and go into a ledger as they are.

The ledger also keeps what the state said, in absolute values of its own on-time rows: closed days, and queues
that have left the state, are found there. On-time values and late rows share no event, so their sum is exact.
A user with a late row that matters has its labels written anew from the ledger; everybody else's come
straight from the state. What is read of the ledger depends on the late rows of a batch, not on time.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom import dims
from labelloom.functions.calendar import day_number, day_window
from labelloom.functions.text import counts_text, quoted, row_key
from labelloom.operators import classify, exposure, interest
from labelloom.plans import labels
from labelloom.streaming import queue_state

_OWN = {c: f"own_{c}" for c in interest.COUNTS}
_OWN_LAST = [f"own_last_{c}_ts" for c in dims.CHANNELS]


class Ledger:
    """What each micro-batch saw, in a folder of its own, late rows apart from on-time values. A replay replaces its folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path
        self.schema = T.StructType([f for f in schema.fields if f.name != "late"])

    def store(self, rows: DataFrame, batch_id: int) -> None:
        """One action, so the micro-batch and its state are worked out once; all else reads what is stored."""
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{self.path}/batch={batch_id}")

    def rows(self, upto: int | None = None) -> DataFrame:
        """All rows with ``batch`` and ``late``. Batches behind ``upto`` are of an earlier try and not read."""
        located = self.schema.add("batch", T.LongType()).add("late", T.BooleanType())
        try:
            rows = self.spark.read.schema(located).parquet(self.path)
            return rows if upto is None else rows.where(F.col("batch") <= upto)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], located)


def now_ms(behind_ms: int = 0) -> Column:
    """The clock of a micro-batch; ``behind_ms`` sets it back for a stream that replays old events."""
    return F.unix_millis(F.current_timestamp()) - F.lit(behind_ms)


def parted(rows: DataFrame, lateness_ms: int, behind_ms: int = 0) -> tuple[DataFrame, DataFrame]:
    """The rows on time, with ``event_time`` and its watermark, and the late ones. A stamp ahead of the clock is on
    time, and counts as now for the watermark alone."""
    limit = now_ms(behind_ms) - lateness_ms
    on_time = rows.where(F.col("ts_ms") >= limit)
    return _timed(on_time, lateness_ms, behind_ms), rows.where(F.col("ts_ms") < limit)


def _timed(rows: DataFrame, lateness_ms: int, behind_ms: int) -> DataFrame:
    stamp = F.timestamp_millis(F.least(F.col("ts_ms"), now_ms(behind_ms)))
    return rows.withColumn("event_time", stamp).withWatermark("event_time", f"{lateness_ms} milliseconds")


# Scores


def _score_columns(rows: DataFrame, late: bool) -> DataFrame:
    columns = ["uid", "day", *interest.COUNTS, *[f"last_{c}_ts" for c in dims.CHANNELS], *_OWN.values(), *_OWN_LAST]
    return rows.select(*columns, F.lit(late).alias("late"))


def score_rows(
    clicks: DataFrame, searches: DataFrame, lateness_ms: int, behind_ms: int = 0, offset_ms: int = dims.DAY_OFFSET_MS
) -> DataFrame:
    """The stream a ledger of scores keeps. On time: for each user and day touched the two-day counts that end with
    the day, and its own. Late: a row for each event, with its own counts of 0 or 1.

    Each event enters the day it lies on and the next one, so yesterday is at hand without a lookup, and the state of a
    day leaves when the watermark passes it."""
    (timely_clicks, late_clicks), (timely_searches, late_searches) = (
        parted(log, lateness_ms, behind_ms) for log in (clicks, searches)
    )
    timed = labels.scored_actions(timely_clicks, timely_searches)
    mark = timed.schema["event_time"].metadata
    placed = timed.withColumn("ahead", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "counted", F.expr(f"timestamp_millis(ts_ms + ahead * {dims.DAY_MS}L)").alias("counted", metadata=mark)
    )
    own = [f"sum(CASE WHEN ahead = 0 THEN {hit} ELSE 0 END) AS {_OWN[c]}" for c, hit in interest.HITS.items()]
    own += [
        f"max(CASE WHEN ahead = 0 AND channel = {quoted(c)} THEN ts_ms END) AS {name}" for c, name in zip(dims.CHANNELS, _OWN_LAST)
    ]
    days = placed.groupBy("uid", day_window("counted", 1, offset_ms)).agg(
        *interest.aggregates(interest.HIT_SUMS + interest.LAST_SEEN + own)
    ).withColumn("day", F.expr(day_number("unix_millis(window.start)", offset_ms)))
    # A day without an event of its own says nothing yet.
    speaking = days.where(f"coalesce({', '.join(_OWN_LAST)}) IS NOT NULL")
    late = interest.with_day(labels.scored_actions(late_clicks, late_searches), offset_ms).selectExpr(
        "uid", "day", *[f"bigint({hit}) AS {_OWN[c]}" for c, hit in interest.HITS.items()],
        *[f"CASE WHEN channel = {quoted(c)} THEN ts_ms END AS {name}" for c, name in zip(dims.CHANNELS, _OWN_LAST)],
        *[f"CAST(NULL AS bigint) AS {c}" for c in interest.COUNTS], *[f"CAST(NULL AS bigint) AS last_{c}_ts" for c in dims.CHANNELS],
    )
    return _score_columns(speaking, False).unionByName(_score_columns(late, True))


def day_totals(kept: DataFrame) -> DataFrame:
    """``uid, day``, its counts and last times, from the rows of a ledger: what the state said last, and all late rows."""
    values = [*_OWN.values(), *_OWN_LAST]
    said = f"max_by(struct({', '.join(values)}), batch) FILTER (WHERE NOT late)"
    totals = kept.groupBy("uid", "day").agg(
        F.expr(f"{said} AS said"),
        *[F.expr(f"sum({v}) FILTER (WHERE late) AS late_{v}") for v in _OWN.values()],
        *[F.expr(f"max({v}) FILTER (WHERE late) AS late_{v}") for v in _OWN_LAST],
    )
    return totals.selectExpr(
        "uid", "day", *[f"coalesce(said.{v}, 0) + coalesce(late_{v}, 0) AS {c}" for c, v in _OWN.items()],
        *[f"greatest(said.{v}, late_{v}) AS last_{c}_ts" for c, v in zip(dims.CHANNELS, _OWN_LAST)],
    )


def score_cells(ledger: Ledger, on_flat: str = "nan") -> Callable[[DataFrame, int], DataFrame]:
    """Label rows of a micro-batch of ``score_rows``."""

    def cells(rows: DataFrame, batch_id: int) -> DataFrame:
        ledger.store(rows, batch_id)
        kept = ledger.rows(upto=batch_id)
        batch = kept.where(F.col("batch") == batch_id)
        spoken, late = batch.where("NOT late"), kept.where("late")
        # Users with a late row now, or one that belongs to the two days they have just been counted for.
        touched = spoken.select("uid", "day").join(late.selectExpr("uid", "day AS late_day"), "uid").where("late_day BETWEEN day - 1 AND day")
        anew = batch.where("late").select("uid").unionByName(touched.select("uid")).distinct()
        own = [
            f"if({last} IS NOT NULL, {counts_text(names)}, NULL) AS biz_{ch}"
            for ch, last, names in zip(dims.CHANNELS, _OWN_LAST, (interest.CLICK_COUNTS, interest.SEARCH_COUNTS))
        ]
        # As a window does it: the day's own channel speaks, with the counts of both days.
        straight = spoken.join(anew, "uid", "left_anti").selectExpr(
            f"{row_key()} AS row_key", "last_click_ts", "last_search_ts", *own, *interest.COUNTS
        )
        scored = interest.with_scores(interest.with_raw_scores(straight), on_flat)
        again = labels.scores_of_days(day_totals(kept.join(anew, "uid", "left_semi")), on_flat)
        return labels.score_cells(scored).unionByName(labels.score_cells(again))

    return cells


# Daily counts


def count_rows(
    clicks: DataFrame, searches: DataFrame, lateness_ms: int, behind_ms: int = 0, offset_ms: int = dims.DAY_OFFSET_MS
) -> DataFrame:
    """``uid, day, channel, biz, n, late``: counts of the open days, in absolute values, and a row for each late event."""
    (timely_clicks, late_clicks), (timely_searches, late_searches) = (
        parted(log, lateness_ms, behind_ms) for log in (clicks, searches)
    )
    timed = labels.scored_actions(timely_clicks, timely_searches)
    mark = timed.schema["event_time"].metadata
    timed = timed.withColumn("event_time", F.timestamp_millis("ts_ms").alias("event_time", metadata=mark))
    counts = timed.groupBy("uid", day_window("event_time", 1, offset_ms), "channel", "biz").agg(F.count("*").alias("n"))
    counts = counts.selectExpr("uid", f"{day_number('unix_millis(window.start)', offset_ms)} AS day", "channel", "biz", "n", "false AS late")
    late = interest.with_day(labels.scored_actions(late_clicks, late_searches), offset_ms)
    return counts.unionByName(late.selectExpr("uid", "day", "channel", "biz", "1L AS n", "true AS late"))


def counts_of(ledger: Ledger, upto: int) -> DataFrame:
    """``uid, day, channel, biz, n`` from the ledger of ``count_rows``."""
    totals = ledger.rows(upto).groupBy("uid", "day", "channel", "biz").agg(
        # Counts of a day only grow, so the highest is the newest.
        F.expr("coalesce(max(n) FILTER (WHERE NOT late), 0) + coalesce(sum(n) FILTER (WHERE late), 0) AS n")
    )
    return totals


def count_cells(ledger: Ledger) -> Callable[[DataFrame, int], DataFrame]:
    """The counts of every key that a micro-batch of ``count_rows`` touched."""

    def cells(rows: DataFrame, batch_id: int) -> DataFrame:
        ledger.store(rows, batch_id)
        kept = ledger.rows(upto=batch_id)
        batch, keys = kept.where(F.col("batch") == batch_id), ["uid", "day", "channel", "biz"]
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
        # Keys with late rows, now or before, are added up; the others are what the state says.
        late = kept.where("late").select(*keys).distinct()
        anew = batch.select(*keys).distinct().alias("t").join(late.alias("k"), same, "left_semi")
        straight = batch.where("NOT late").alias("t").join(late.alias("k"), same, "left_anti").select(*keys, "n")
        summed = kept.alias("t").join(anew.alias("k"), same, "left_semi").groupBy(*keys).agg(
            F.expr("coalesce(max(n) FILTER (WHERE NOT late), 0) + coalesce(sum(n) FILTER (WHERE late), 0) AS n")
        )
        return straight.unionByName(summed)

    return cells


# Exposures


def exposure_rows(
    exposures: DataFrame, lateness_ms: int, behind_ms: int = 0, length: int = dims.QUEUE_LENGTH, gap_ms: int = dims.IDLE_GAP_MS
) -> DataFrame:
    """The stream a ledger of exposures keeps. On time: for each user touched the entries in the state, newest last. Late:
    a row for each exposure, as its only entry. A queue leaves the state when its user has been idle for ``gap_ms``."""
    shown = classify.exclusive_exposures(exposures.drop("event_time"))
    limit = now_ms(behind_ms) - lateness_ms
    late = shown.where(F.col("ts_ms") < limit)
    trimmed = shown.where(F.col("ts_ms") >= limit).select("uid", "biz", "ts_ms", "event_id").mapInArrow(
        queue_state.keep_newest(length), queue_state.TRIMMED
    )
    # A watermark does not pass through Python, so it is set behind it.
    queues = _timed(trimmed, lateness_ms, behind_ms).groupBy("uid").transformWithState(
        queue_state.LastExposures(length, gap_ms, forgets=True), queue_state.OUTPUT, outputMode="Update", timeMode="EventTime",
    )
    entry = "array(named_struct('ts_ms', ts_ms, 'event_id', event_id, 'biz', biz)) AS entries"
    return queues.selectExpr("uid", "last_ts", "queue", "entries", "false AS late").unionByName(
        late.selectExpr("uid", "ts_ms AS last_ts", "CAST(NULL AS array<string>) AS queue", entry, "true AS late")
    )


def entries_of(kept: DataFrame) -> DataFrame:
    """``uid, biz, ts_ms, event_id``: every exposure that the rows of a ledger know. The state names an entry again in every
    batch; as often as it did at once, it was there, and late ones come on top."""
    key = ["uid", "biz", "ts_ms", "event_id"]
    spread = kept.selectExpr("uid", "batch", "late", "inline(entries)")
    at_once = spread.groupBy(*key, "batch", "late").agg(F.count("*").alias("n"))
    held = at_once.groupBy(*key).agg(
        F.expr("coalesce(max(n) FILTER (WHERE NOT late), 0) + coalesce(sum(n) FILTER (WHERE late), 0) AS n")
    )
    return held.select(*key, F.explode(F.expr("sequence(1L, n)")).alias("copy")).drop("copy")


def exposure_cells(
    ledger: Ledger, length: int = dims.QUEUE_LENGTH, gap_ms: int = dims.IDLE_GAP_MS, pad_below: int = dims.PAD_BELOW
) -> Callable[[DataFrame, int], DataFrame]:
    """Label rows of a micro-batch of ``exposure_rows``."""

    def cells(rows: DataFrame, batch_id: int) -> DataFrame:
        ledger.store(rows, batch_id)
        kept = ledger.rows(upto=batch_id)
        batch = kept.where(F.col("batch") == batch_id)
        spoken, late = batch.where("NOT late"), kept.where("late")
        # A late exposure matters to a queue unless twelve newer ones, or a pause, lie between.
        met = spoken.selectExpr("uid", "entries[0].ts_ms AS oldest", f"size(entries) >= {length} AS filled").join(
            late.selectExpr("uid", "last_ts AS late_ts"), "uid"
        ).where(f"late_ts >= oldest OR (NOT filled AND late_ts > oldest - {gap_ms}L)")
        anew = batch.where("late").select("uid").unionByName(met.select("uid")).distinct()
        straight = spoken.join(anew, "uid", "left_anti").selectExpr("uid", "last_ts", *exposure.counts_of_array("queue"))
        again = exposure.latest_counts(entries_of(kept.join(anew, "uid", "left_semi")), length, gap_ms)
        both = straight.unionByName(again.select(*straight.columns))
        return labels.exposure_cells(labels.exposure_texts(both, pad_below))

    return cells
