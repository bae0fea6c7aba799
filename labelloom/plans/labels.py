"""Label rows ``(row_key, label, value, write_ts, expire_ts)`` of each job, batch form.

``write_ts`` is the time of the event that wrote the label. A time to live counts from there.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.functions.text import counts_text, last_action_text, quoted, quoted_list, row_key, scores_text
from labelloom.operators import classify, counters, exposure, interest, last_action
from labelloom.schemas import LABEL_COLUMNS


def cell(label: str, value: str, write_ts: str, ttl_ms: int) -> str:
    """One label of a wide row as a struct; NULL value or time means the row does not write it."""
    return (
        f"named_struct('label', {quoted(label)}, 'value', {value}, 'write_ts', {write_ts},"
        f" 'expire_ts', {write_ts} + {ttl_ms}L)"
    )


def unfold(rows: DataFrame, cells: list[str], more: str = "array()") -> DataFrame:
    """One output row for every cell a row writes; no shuffle, the input is read once. ``more`` is an array of cells."""
    all_cells = f"array({', '.join(cells)})" if more == "array()" else f"concat(array({', '.join(cells)}), {more})"
    exploded = rows.selectExpr("row_key", f"inline({all_cells})")
    return exploded.where("value IS NOT NULL AND write_ts IS NOT NULL").select(*LABEL_COLUMNS)


def counter_cells(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "row_key", "label", "string(n) AS value", "last_ts AS write_ts", "CAST(NULL AS bigint) AS expire_ts"
    )


_LAST_BIZ_CELLS = [cell("user_last_biz", "user_last_biz", "last_ts", dims.LAST_BIZ_TTL_MS)]
_SCORE_CELLS = [
    cell("biz_score", scores_text(interest.SCORES), "greatest(last_click_ts, last_search_ts)", dims.SCORE_TTL_MS),
    *[cell(f"biz_{ch}", f"biz_{ch}", f"last_{ch}_ts", dims.SCORE_TTL_MS) for ch in dims.CHANNELS],
]


def last_biz_cells(last: DataFrame) -> DataFrame:
    return unfold(last, _LAST_BIZ_CELLS)


def score_cells(scored: DataFrame) -> DataFrame:
    """From ``row_key``, the scores, ``biz_click``, ``biz_search`` and the two last-seen times."""
    return unfold(scored, _SCORE_CELLS)


def exposure_cells(texts: DataFrame) -> DataFrame:
    """From ``row_key, last_ts`` and the two texts."""
    names = ("expose_least_biz_7d", "expose_biz_his")
    return unfold(texts, [cell(n, n, "last_ts", dims.EXPOSURE_TTL_MS) for n in names])


def number_labels(clicks: DataFrame, searches: DataFrame) -> DataFrame:
    labelled = classify.card_click_labels(clicks).unionByName(classify.number_search_labels(searches))
    return counter_cells(counters.count_labels(labelled))


def last_biz_labels(clicks: DataFrame, searches: DataFrame, zone: str | None = None) -> DataFrame:
    return last_biz_cells(last_action.last_action(classify.both_channels(clicks, searches), zone))


def scored_actions(clicks: DataFrame, searches: DataFrame) -> DataFrame:
    """Both channels with the five-business dictionary of the score."""
    return classify.both_channels(clicks, searches, dims.SCORED_BIZ_OF_MODEL)


def latest_scores(actions: DataFrame, on_flat: str = "nan") -> DataFrame:
    """Per user the scores at the last event and the count texts at the last click and search."""
    return _scored(interest.latest_counts(actions), on_flat)


def scores_of_days(days: DataFrame, on_flat: str = "nan") -> DataFrame:
    """The same from day totals (see ``interest.latest_of_days``)."""
    return _scored(interest.latest_of_days(days), on_flat)


def _scored(latest: DataFrame, on_flat: str, *also: str) -> DataFrame:
    own = [
        f"if(at_{ch} IS NULL, NULL, {counts_text([f'at_{ch}.{c}' for c in names])}) AS biz_{ch}"
        for ch, names in zip(dims.CHANNELS, (interest.CLICK_COUNTS, interest.SEARCH_COUNTS))
    ]
    latest = latest.selectExpr(
        f"{row_key()} AS row_key", "last_click_ts", "last_search_ts", *own, *also, "at_last.*"
    )
    return interest.with_scores(interest.with_raw_scores(latest), on_flat)


def score_labels(clicks: DataFrame, searches: DataFrame, on_flat: str = "nan") -> DataFrame:
    return score_cells(latest_scores(scored_actions(clicks, searches), on_flat))


def exposure_texts(counts: DataFrame, pad_below: int = dims.PAD_BELOW) -> DataFrame:
    return counts.selectExpr(
        f"{row_key()} AS row_key",
        "last_ts",
        f"{exposure.least_text(pad_below)} AS expose_least_biz_7d",
        f"{exposure.history_text(pad_below)} AS expose_biz_his",
    )


def exposure_labels(exposures: DataFrame, pad_below: int = dims.PAD_BELOW) -> DataFrame:
    counts = exposure.latest_counts(classify.exclusive_exposures(exposures))
    return exposure_cells(exposure_texts(counts, pad_below))


def all_labels(clicks: DataFrame, searches: DataFrame, exposures: DataFrame, zone: str | None = None) -> DataFrame:
    """The shared label table: every job writes its own labels, so a union is enough."""
    return action_labels(clicks, searches, zone).unionByName(exposure_labels(exposures))


def action_labels(clicks: DataFrame, searches: DataFrame, zone: str | None = None) -> DataFrame:
    """Number, last-action and score labels at once, each log read once.

    Totals by user, day, channel, business and counter combine before the first shuffle. Of a user they are few, and
    all else is worked out from them where the user is: what the counters add up to, the newest action, and the
    counts of the last two days.
    """
    totals = interest.with_day(classify.labelled_actions(clicks, searches)).groupBy("uid", "day", "channel", "biz", "label").agg(
        F.count("*").alias("n"), F.max(F.expr(last_action.ORDER_KEY)).alias("key")
    ).repartition("uid").selectExpr("*", f"{last_action.time_of('key')} AS ts_ms")
    of_label = "OVER (PARTITION BY uid, label)"
    counted = totals.selectExpr("*", f"named_struct('label', label, 'n', sum(n) {of_label}, 'ts', max(ts_ms) {of_label}) AS number")
    days = counted.groupBy("uid", "day").agg(
        *[F.expr(f"sum(({hit}) * n) AS {c}") for c, hit in interest.HITS.items()],
        *interest.aggregates(interest.LAST_SEEN),
        F.expr("max(struct(key, channel, biz, ts_ms)) AS newest"),
        F.expr("collect_set(CASE WHEN label IS NOT NULL THEN number END) AS numbers"),
    )
    latest = interest.latest_of_days(
        days, {"newest": "max(newest)", "numbers": "array_distinct(flatten(collect_list(numbers)))"}
    )
    text = last_action_text("newest.channel", "newest.biz", "newest.ts_ms", zone)
    rows = _scored(latest, "nan", f"{text} AS user_last_biz", "newest.ts_ms AS last_ts", "numbers")
    numbers = (
        "transform(numbers, x -> named_struct('label', x.label, 'value', string(x.n), 'write_ts', x.ts,"
        " 'expire_ts', CAST(NULL AS bigint)))"
    )
    return unfold(rows, [*_LAST_BIZ_CELLS, *_SCORE_CELLS], numbers)


def visible(labels: DataFrame, as_of_ms: int | Column) -> DataFrame:
    """What a reader sees at ``as_of_ms``: expired cells are gone. The time may be a scalar subquery, which then is part
    of the plan."""
    now = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms)
    return labels.where(F.col("expire_ts").isNull() | (F.col("expire_ts") > now))


def living_from(labels: DataFrame, now_ms: int) -> DataFrame:
    """The same rows with their time to live counted from ``now_ms``, the moment a live job writes them,
    instead of from their event. ``write_ts`` stays the event's, which decides what is newest."""
    return labels.withColumn("expire_ts", F.expr(f"expire_ts - write_ts + {now_ms}L"))


def wide(labels: DataFrame, names: Iterable[str] = tuple(dims.KNOWN_LABELS), rest: str | None = "other_labels") -> DataFrame:
    """One row per user, one column per label, in one shuffle; the names are given, not looked up.

    Search labels carry the type as logged, so more labels than the known ones may exist: they come as
    one map column named ``rest``, or are left out when that is None.
    """
    names = list(names)
    columns = [f"max(CASE WHEN label = {quoted(n)} THEN value END) AS {_identifier(n)}" for n in names]
    if rest is not None:
        others = f"CASE WHEN label NOT IN ({quoted_list(names)}) THEN struct(label, value) END"
        columns.append(f"map_from_entries(array_sort(collect_list({others}))) AS {_identifier(rest)}")
    return labels.groupBy("row_key").agg(*[F.expr(c) for c in columns])


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
