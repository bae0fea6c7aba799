"""The registered queries: one per operator, over the whole ``events`` table."""

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.functions.text import counts_text, lookup, null_text, row_key, scores_text
from labelloom.operators import classify, counters, exposure, interest, last_action
from labelloom.plans import labels
from labelloom.schemas import CLICK, EXPOSURE, LOGS, SEARCH
from labelloom.shared import work_folder
from labelloom.sources import events_table as ev
from labelloom.sources.ingest import ingest, read_ingested
from labelloom.sources.logs import file_backfill
from labelloom.sources.parse import parse, read_log, rejects, with_event_time
from labelloom.streaming import bounded, jobs, watermark
from labelloom.streaming.store import ChangeTable, label_table

Query = Callable[[SparkSession, str], DataFrame]
ZONE = "UTC"
_ADAPTERS = {CLICK.name: ev.click_log, SEARCH.name: ev.search_log, EXPOSURE.name: ev.exposure_log}


def _log(spark: SparkSession, sf_dir: str, log=CLICK) -> DataFrame:
    return _ADAPTERS[log.name](ev.read_events(spark, sf_dir))


def _clicks(spark, sf_dir):
    return _log(spark, sf_dir, CLICK)


def _searches(spark, sf_dir):
    return _log(spark, sf_dir, SEARCH)


def _exposures(spark, sf_dir):
    return _log(spark, sf_dir, EXPOSURE)


def _broken_every(n: int, good: Column, bad: Column) -> Column:
    """Spoils some of the lines so the reject path has work; every line is still read."""
    return F.when(F.col("event_id") % n == 0, bad).otherwise(good)


def _raw(spark: SparkSession, sf_dir: str, log) -> DataFrame:
    lines = ev.as_json(_log(spark, sf_dir, log), log)
    return lines.select(_broken_every(97, F.col("value"), F.lit("{bad")).alias("value"), "event_id")


def _raw_with_all_faults(spark: SparkSession, sf_dir: str, log) -> DataFrame:
    user = _broken_every(89, F.col(log.user_field), F.lit(None))
    stamp = _broken_every(83, F.col("ts_ms").cast("string"), F.lit("xx"))
    lines = ev.as_json(_log(spark, sf_dir, log), log, ts=stamp, uid=user)
    return lines.select(_broken_every(97, F.col("value"), F.lit("{bad")).alias("value"), "event_id")


# Sources and parsing


def parse_click_log(spark, sf_dir):
    return classify.click_actions(read_log(_raw(spark, sf_dir, CLICK), CLICK))


def parse_search_log(spark, sf_dir):
    return classify.search_actions(read_log(_raw(spark, sf_dir, SEARCH), SEARCH))


def parse_exposure_log(spark, sf_dir):
    rows = read_log(_raw(spark, sf_dir, EXPOSURE), EXPOSURE)
    return rows.selectExpr("uid", f"{lookup(dims.BIZ_OF_MODEL, 'biz_type')} AS biz", "ts_ms", "event_id")


def backfill_logs(spark, sf_dir):
    """The logs as files of lines, read, ingested (twice, as after a failed job) and counted."""
    folder, parts = work_folder(spark), []
    for log in LOGS:
        ev.as_json(_log(spark, sf_dir, log), log).select("value").write.text(f"{folder}/lines/{log.name}")
        for _ in range(2):
            ingest(file_backfill(spark, f"{folder}/lines/{log.name}"), log, f"{folder}/typed")
        parts.append(read_ingested(spark, log, f"{folder}/typed").select(F.lit(log.name).alias("log")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("log").agg(F.count("*").alias("rows"))


def parse_rejects(spark, sf_dir):
    parts = [rejects(parse(_raw_with_all_faults(spark, sf_dir, log), log), log) for log in LOGS]
    bad = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return bad.groupBy("log", "reason").agg(F.count("*").alias("n"))


def lenient_ts_cast(spark, sf_dir):
    """A third of the lines each: a plain number, a quoted one, a floating-point one."""
    quoted = F.to_json(F.struct("uid", F.col("ts_ms").cast("string").alias("ts")))
    plain = F.to_json(F.struct("uid", F.col("ts_ms").alias("ts")))
    floating = F.to_json(F.struct("uid", F.col("ts_ms").cast("double").alias("ts")))
    line = F.when(F.col("event_id") % 3 == 0, floating).otherwise(_broken_every(2, plain, quoted))
    lines = _clicks(spark, sf_dir).select(line.alias("value"), "event_id")
    return read_log(lines, CLICK).select("event_id", "ts_ms")


def event_time_watermark(spark, sf_dir):
    rows = with_event_time(classify.click_actions(_clicks(spark, sf_dir)))
    return rows.select("event_id", F.unix_millis("event_time").alias("event_ms"))


# Dictionaries and filters


def biz_dictionary(spark, sf_dir):
    rows = _exposures(spark, sf_dir).selectExpr(
        "biz_type AS raw",
        f"{null_text(lookup(dims.BIZ_OF_MODEL, 'biz_type'))} AS mapped",
        f"{null_text(lookup(dims.SCORED_BIZ_OF_MODEL, 'biz_type'))} AS mapped_for_score",
    )
    return rows.groupBy("raw", "mapped", "mapped_for_score").agg(F.count("*").alias("n"))


def number_type_dictionary(spark, sf_dir):
    mapped = null_text(lookup(dims.NUMBER_TYPE_OF_CODE, "num_type"))
    rows = _clicks(spark, sf_dir).selectExpr("num_type AS raw", f"{mapped} AS mapped")
    return rows.groupBy("raw", "mapped").agg(F.count("*").alias("n"))


def card_click_classified(spark, sf_dir):
    return classify.card_click_labels(_clicks(spark, sf_dir))


def number_search_filtered(spark, sf_dir):
    return classify.number_search_labels(_searches(spark, sf_dir))


def exclusive_exposures(spark, sf_dir):
    return classify.exclusive_exposures(_exposures(spark, sf_dir)).select("uid", "biz", "event_id")


def unmapped_exposures(spark, sf_dir):
    rows = classify.unmapped_exposures(_exposures(spark, sf_dir))
    return rows.groupBy("uid").agg(F.count("*").alias("n"))


def user_row_key(spark, sf_dir):
    return _exposures(spark, sf_dir).select("uid").distinct().selectExpr("uid", f"{row_key()} AS row_key")


# Number counters


def number_click_counts(spark, sf_dir):
    rows = classify.card_click_labels(_clicks(spark, sf_dir)).where("endswith(label, '_clicks')")
    return counters.count_labels(rows).drop("last_ts")


def number_x_counts(spark, sf_dir):
    rows = classify.card_click_labels(_clicks(spark, sf_dir)).where("endswith(label, '_x')")
    return counters.count_labels(rows).drop("last_ts")


def number_search_counts(spark, sf_dir):
    return counters.count_labels(classify.number_search_labels(_searches(spark, sf_dir))).drop("last_ts")


# Last action


def last_biz(spark, sf_dir):
    actions = classify.both_channels(_clicks(spark, sf_dir), _searches(spark, sf_dir))
    return last_action.last_action(actions, ZONE).drop("last_ts")


# Interest score


def _scored(spark, sf_dir):
    return labels.scored_actions(_clicks(spark, sf_dir), _searches(spark, sf_dir))


def co_keyed_channels(spark, sf_dir):
    by_channel = [F.expr(f"count_if(channel = '{c}') AS n_{c}") for c in dims.CHANNELS]
    return _scored(spark, sf_dir).groupBy("uid").agg(*by_channel)


def daily_biz_counts(spark, sf_dir):
    return interest.daily_counts(_scored(spark, sf_dir))


def biz_actions_trace(spark, sf_dir):
    trace = interest.counts_trace(_scored(spark, sf_dir))
    return trace.selectExpr("event_id", "channel", *interest.own_channel_counts())


def biz_raw_score_trace(spark, sf_dir):
    return interest.with_raw_scores(interest.counts_trace(_scored(spark, sf_dir))).select(
        "event_id", *interest.RAW_SCORES
    )


# Weights that differ from each other show that each one reaches its own count.
TEST_WEIGHTS = {
    "click_weight": {"terminal": 1, "broadband": 2, "package": 3, "number": 4, "family": 5},
    "search_weight": {"terminal": 7, "broadband": 6, "package": 5, "number": 4, "family": 3},
    "biz_weight": {"terminal": 2, "broadband": 3, "package": 1, "number": 5, "family": 4},
}


def biz_weighted_score_trace(spark, sf_dir):
    trace = interest.counts_trace(_scored(spark, sf_dir))
    return interest.with_raw_scores(trace, **TEST_WEIGHTS).select("event_id", *interest.RAW_SCORES)


def _rounded(scored: DataFrame, *keep: str) -> DataFrame:
    """Scores to 5 places; users without a score (all counts equal) are flagged and show 0."""
    return scored.selectExpr(
        *keep,
        f"int(isnan({interest.SCORES[0]})) AS flat",
        *[f"round(nanvl({c}, 0D), 5) AS {c}" for c in interest.SCORES],
    )


def biz_score_trace(spark, sf_dir):
    raw = interest.with_raw_scores(interest.counts_trace(_scored(spark, sf_dir)))
    return _rounded(interest.with_scores(raw), "event_id")


def biz_score_trace_uniform(spark, sf_dir):
    raw = interest.with_raw_scores(interest.counts_trace(_scored(spark, sf_dir)))
    scored = interest.with_scores(raw, on_flat="uniform")
    return scored.selectExpr("event_id", *[f"round({c}, 5) AS {c}" for c in interest.SCORES])


def biz_label_trace(spark, sf_dir):
    """What every click and search writes: the scores and its own channel's counts."""
    raw = interest.with_raw_scores(interest.counts_trace(_scored(spark, sf_dir)))
    scored = interest.with_scores(raw).selectExpr("*", *interest.own_channel_counts())
    return scored.selectExpr(
        "event_id",
        f"{row_key()} AS row_key",
        "concat('biz_', channel) AS label",
        f"{counts_text(interest.ACTIONS)} AS counts",
        f"{scores_text(interest.SCORES)} AS biz_score",
    )


def biz_score_latest(spark, sf_dir):
    return _rounded(labels.latest_scores(_scored(spark, sf_dir)), "row_key")


def biz_click_label(spark, sf_dir):
    latest = labels.latest_scores(_scored(spark, sf_dir))
    return latest.where("biz_click IS NOT NULL").select("row_key", "biz_click")


def biz_search_label(spark, sf_dir):
    latest = labels.latest_scores(_scored(spark, sf_dir))
    return latest.where("biz_search IS NOT NULL").select("row_key", "biz_search")


def biz_score_label(spark, sf_dir):
    latest = labels.latest_scores(_scored(spark, sf_dir))
    return latest.selectExpr("row_key", f"{scores_text(interest.SCORES)} AS biz_score")


# Exposures


def _shown(spark, sf_dir):
    return classify.exclusive_exposures(_exposures(spark, sf_dir))


def expose_last12_trace(spark, sf_dir):
    return exposure.queue_trace(_shown(spark, sf_dir)).select("event_id", F.concat_ws(",", "queue").alias("queue"))


def expose_last12_trace_short_gap(spark, sf_dir):
    trace = exposure.queue_trace(_shown(spark, sf_dir), gap_ms=2 * dims.DAY_MS)
    return trace.select("event_id", F.concat_ws(",", "queue").alias("queue"))


def expose_gap_groups(spark, sf_dir):
    return exposure.gap_groups(_shown(spark, sf_dir), gap_ms=2 * dims.DAY_MS)


def expose_counts_trace(spark, sf_dir):
    trace = exposure.queue_trace(_shown(spark, sf_dir))
    counts = trace.selectExpr("event_id", *exposure.counts_of_array("queue"))
    return counts.selectExpr("event_id", *exposure.COUNTS, f"int({exposure.is_padded()}) AS padded")


def expose_label_trace(spark, sf_dir):
    """What every exposure writes."""
    trace = exposure.queue_trace(_shown(spark, sf_dir))
    counts = trace.selectExpr("event_id", "uid", *exposure.counts_of_array("queue"))
    return counts.selectExpr(
        "event_id",
        f"{row_key()} AS row_key",
        f"{exposure.least_text()} AS expose_least_biz_7d",
        f"{exposure.history_text()} AS expose_biz_his",
    )


def expose_history_label(spark, sf_dir):
    texts = labels.exposure_texts(exposure.latest_counts(_shown(spark, sf_dir)))
    return texts.select("row_key", "expose_biz_his")


def expose_least_label(spark, sf_dir):
    texts = labels.exposure_texts(exposure.latest_counts(_shown(spark, sf_dir)))
    return texts.select("row_key", "expose_least_biz_7d")


def expose_labels_short_gap(spark, sf_dir):
    """Labels with a 2-day pause and padding below six: the parameters the defaults leave idle."""
    counts = exposure.latest_counts(_shown(spark, sf_dir), gap_ms=2 * dims.DAY_MS)
    return labels.exposure_texts(counts, pad_below=6).drop("last_ts")


# Label table


def _all_labels(spark, sf_dir):
    return labels.all_labels(_clicks(spark, sf_dir), _searches(spark, sf_dir), _exposures(spark, sf_dir), ZONE)


def _never_as_minus_one(rows: DataFrame) -> DataFrame:
    return rows.withColumn("expire_ts", F.coalesce("expire_ts", F.lit(-1))).drop("write_ts")


def label_table_long(spark, sf_dir):
    return _never_as_minus_one(_all_labels(spark, sf_dir))


def labels_as_of(spark, sf_dir):
    newest = _exposures(spark, sf_dir).agg(F.max("ts_ms")).scalar()
    return _never_as_minus_one(labels.visible(_all_labels(spark, sf_dir), newest))


def label_table_wide(spark, sf_dir):
    rows = labels.wide(_all_labels(spark, sf_dir))
    return rows.withColumn("other_labels", F.to_json("other_labels"))


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        parse_click_log, parse_search_log, parse_exposure_log, backfill_logs, parse_rejects, lenient_ts_cast,
        event_time_watermark, biz_dictionary, number_type_dictionary, card_click_classified,
        number_search_filtered, exclusive_exposures, unmapped_exposures, user_row_key, number_click_counts,
        number_x_counts, number_search_counts, last_biz, co_keyed_channels, daily_biz_counts,
        biz_actions_trace, biz_raw_score_trace, biz_weighted_score_trace, biz_score_trace,
        biz_score_trace_uniform, biz_label_trace, biz_score_latest, biz_click_label, biz_search_label, biz_score_label,
        expose_last12_trace, expose_last12_trace_short_gap, expose_gap_groups, expose_counts_trace,
        expose_label_trace, expose_history_label, expose_least_label, expose_labels_short_gap, label_table_long, labels_as_of,
        label_table_wide,
    )
}


# Streams: the same rows through a file stream into the label table, then read back


def _to_end(changed: DataFrame, table: ChangeTable, job: str) -> DataFrame:
    query = jobs.run(changed, table, job, availableNow=True)
    query.awaitTermination()
    return table.current()


def _streamed_logs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [_ADAPTERS[log.name](ev.stream_events(spark, sf_dir)) for log in LOGS]


def stream_number_counts(spark, sf_dir):
    clicks, searches, _ = _streamed_logs(spark, sf_dir)
    table = label_table(spark, work_folder(spark))
    rows = _to_end(jobs.number_labels(clicks, searches), table, "number_counts")
    return rows.select("row_key", "label", F.col("value").cast("bigint").alias("n"))


def stream_last_biz(spark, sf_dir):
    clicks, searches, _ = _streamed_logs(spark, sf_dir)
    table = label_table(spark, work_folder(spark))
    rows = _to_end(jobs.last_biz_labels(clicks, searches, ZONE), table, "last_biz")
    return rows.select("row_key", F.col("value").alias("user_last_biz"))


def stream_daily_counts(spark, sf_dir):
    clicks, searches, _ = _streamed_logs(spark, sf_dir)
    changed = jobs.daily_counts(clicks, searches)
    table = ChangeTable(spark, work_folder(spark), changed.schema, ["uid", "day", "channel", "biz"])
    return _to_end(changed, table, "daily_counts")


def stream_biz_score(spark, sf_dir):
    clicks, searches, _ = _streamed_logs(spark, sf_dir)
    table = label_table(spark, work_folder(spark))
    return _never_as_minus_one(_to_end(jobs.score_labels(clicks, searches), table, "biz_score"))


LATENESS_MS = 10 * dims.DAY_MS
_PARTS = 4


def _arriving_late(spark: SparkSession, sf_dir: str, start: Callable) -> None:
    """The events in four parts in the order of arrival: every fifth event comes two days late. After each part the
    job that ``start(events, behind_ms)`` begins runs to its end, by a clock that shows the part's last arrival; two
    thirds of a part are on time then, the rest is late."""
    folder = work_folder(spark)
    arrival = F.unix_millis("ts") + F.when(F.col("event_id") % 5 == 0, 2 * dims.DAY_MS).otherwise(0)
    events = ev.read_events(spark, sf_dir).withColumn("arrival", arrival)
    first, last = events.agg(F.min("arrival"), F.max("arrival")).first()
    for part in range(_PARTS):
        rows = events.where(F.expr(f"(arrival - {first}L) * {_PARTS} div {last - first + 1}L = {part}")).drop("arrival")
        rows.write.mode("append").parquet(f"{folder}/events.parquet")
        clock = first + (last - first + 1) * (part + 1) // _PARTS
        start(ev.stream_events(spark, folder), int(time.time() * 1000) - clock).awaitTermination()


def stream_watermark(spark, sf_dir):
    """All events in order of arrival, told apart by the reference's delay of 3 seconds; none is lost."""
    folder = work_folder(spark)

    def start(events, _):
        rows = watermark.marked(ev.exposure_log(events))
        ledger = bounded.Ledger(spark, f"{folder}/marked", rows.schema)
        writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
        return jobs.started(writer.foreachBatch(ledger.store).trigger(availableNow=True), spark)

    _arriving_late(spark, sf_dir, start)
    kept = bounded.Ledger(spark, f"{folder}/marked", watermark.MARKED).rows()
    return kept.selectExpr("event_id", "ts_ms AS event_ms", "int(late) AS late")


def stream_daily_counts_late(spark, sf_dir):
    ledger = table = None

    def start(events, behind_ms):
        nonlocal ledger, table
        rows = bounded.count_rows(ev.click_log(events), ev.search_log(events), LATENESS_MS, behind_ms)
        if table is None:
            ledger = bounded.Ledger(spark, f"{work_folder(spark)}/ledger", rows.schema)
            table = ChangeTable(spark, work_folder(spark), rows.drop("late").schema, ["uid", "day", "channel", "biz"])
        return jobs.run(rows, table, "daily_counts", cells=bounded.count_cells(ledger), availableNow=True)

    _arriving_late(spark, sf_dir, start)
    return table.current()


def stream_biz_score_late(spark, sf_dir):
    table, folder = label_table(spark, work_folder(spark)), work_folder(spark)

    def start(events, behind_ms):
        rows = bounded.score_rows(ev.click_log(events), ev.search_log(events), LATENESS_MS, behind_ms)
        ledger = bounded.Ledger(spark, folder, rows.schema)
        return jobs.run(rows, table, "biz_score", cells=bounded.score_cells(ledger), availableNow=True)

    _arriving_late(spark, sf_dir, start)
    return _never_as_minus_one(table.current())


def stream_exposure_late(spark, sf_dir):
    table, folder = label_table(spark, work_folder(spark)), work_folder(spark)

    def start(events, behind_ms):
        rows = bounded.exposure_rows(ev.exposure_log(events), LATENESS_MS, behind_ms)
        ledger = bounded.Ledger(spark, folder, rows.schema)
        return jobs.run(rows, table, "exposure", cells=bounded.exposure_cells(ledger), availableNow=True)

    _arriving_late(spark, sf_dir, start)
    return labels.wide(table.current(), ["expose_least_biz_7d", "expose_biz_his"], rest=None)


def stream_exposure(spark, sf_dir):
    table = label_table(spark, work_folder(spark))
    rows = _to_end(jobs.exposure_labels(_streamed_logs(spark, sf_dir)[2]), table, "exposure")
    return labels.wide(rows, ["expose_least_biz_7d", "expose_biz_his"], rest=None)


STREAM: dict[str, Query] = {
    f.__name__: f
    for f in (
        stream_number_counts, stream_last_biz, stream_daily_counts, stream_biz_score, stream_exposure, stream_biz_score_late,
        stream_exposure_late, stream_daily_counts_late, stream_watermark,
    )
}
