"""Two-day interest of a user in each business: clicks, searches, score.

"Two-day" is the calendar day of the event and the day before it, in UTC+8 by default. An event
with an unknown business moves no count but still refreshes the labels of its user.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.functions.calendar import day_number
from labelloom.functions.scoring import weighted, with_softmax
from labelloom.functions.text import quoted
from labelloom.operators import ranges

COUNTS = [f"{channel}_{biz}" for channel in dims.CHANNELS for biz in dims.SCORED_BIZ]
CLICK_COUNTS = COUNTS[: len(dims.SCORED_BIZ)]
SEARCH_COUNTS = COUNTS[len(dims.SCORED_BIZ) :]
RAW_SCORES = [f"raw_{biz}" for biz in dims.SCORED_BIZ]
SCORES = [f"score_{biz}" for biz in dims.SCORED_BIZ]
ACTIONS = [f"action_{biz}" for biz in dims.SCORED_BIZ]

# For each count the 0/1 contribution of a row.
HITS = {
    f"{channel}_{biz}": f"CASE WHEN channel = {quoted(channel)} AND biz = {quoted(biz)} THEN 1 ELSE 0 END"
    for channel in dims.CHANNELS
    for biz in dims.SCORED_BIZ
}
# Aggregates shared by the batch and the stream: the ten counts, newest click, newest search.
HIT_SUMS = [f"sum({hit}) AS {name}" for name, hit in HITS.items()]
LAST_SEEN = [f"max(CASE WHEN channel = {quoted(c)} THEN ts_ms END) AS last_{c}_ts" for c in dims.CHANNELS]


def aggregates(texts: list[str]) -> list:
    return [F.expr(t) for t in texts]


def with_day(actions: DataFrame, offset_ms: int = dims.DAY_OFFSET_MS) -> DataFrame:
    return actions.selectExpr("*", f"{day_number('ts_ms', offset_ms)} AS day")


def daily_counts(actions: DataFrame, offset_ms: int = dims.DAY_OFFSET_MS) -> DataFrame:
    """``uid, day, channel, biz, n``: one row for every business seen, known or not."""
    return with_day(actions, offset_ms).groupBy("uid", "day", "channel", "biz").agg(F.count("*").alias("n"))


def latest_counts(actions: DataFrame, offset_ms: int = dims.DAY_OFFSET_MS) -> DataFrame:
    """Per user the two-day counts as of the last click, the last search and the last event.

    At the last event of a day all events of that day are in, so day totals are enough: they
    combine before the shuffle, and what meets per user is one row per active day.
    Columns: uid, last_click_ts, last_search_ts, ``at_click`` and ``at_search`` (own-channel counts
    or NULL), ``at_last`` (all ten counts).
    """
    return latest_of_days(with_day(actions, offset_ms).groupBy("uid", "day").agg(*aggregates(HIT_SUMS + LAST_SEEN)))


def latest_of_days(days: DataFrame, also: dict[str, str] | None = None) -> DataFrame:
    """The same from ``uid, day``, the ten counts of each day, ``last_click_ts`` and ``last_search_ts``. ``also`` names further
    columns of ``days`` and how those of a user become one."""
    also = also or {}
    before = days.selectExpr(
        "*", f"lag(struct(day, {', '.join(COUNTS)})) OVER (PARTITION BY uid ORDER BY day) AS before"
    )
    two_day = before.selectExpr(
        "uid",
        "day",
        "last_click_ts",
        "last_search_ts",
        *also,
        *[f"{c} + CASE WHEN before.day = day - 1 THEN before.{c} ELSE 0 END AS {c}" for c in COUNTS],
    )
    own = [
        f"max_by(struct({', '.join(names)}), CASE WHEN last_{ch}_ts IS NOT NULL THEN day END) AS at_{ch}"
        for ch, names in zip(dims.CHANNELS, (CLICK_COUNTS, SEARCH_COUNTS))
    ]
    return two_day.groupBy("uid").agg(*aggregates([
        "max(last_click_ts) AS last_click_ts",
        "max(last_search_ts) AS last_search_ts",
        *own,
        f"max_by(struct({', '.join(COUNTS)}), day) AS at_last",
        *[f"{joined} AS {name}" for name, joined in also.items()],
    ]))


_TRACE_KEYS = ["uid", "channel", "ts_ms", "event_id"]
_ORDER = ["uid", "ts_ms", "event_id"]
# Everything up to two days ago has dropped out of the two-day counts.
_TOO_OLD = "PARTITION BY uid, slice ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING"


def counts_trace(actions: DataFrame, offset_ms: int = dims.DAY_OFFSET_MS, parts: int | None = None) -> DataFrame:
    """The ten two-day counts after every event, next to ``uid, channel, ts_ms, event_id``.

    The events are cut into ``parts`` slices of about equal length along ``(uid, ts_ms, event_id)``, whoever they
    belong to, and move once. Within a slice the counts run as a window; what the user in whom a slice
    opens did before is carried over. Events that agree in user, time and id stay in one slice.
    """
    rows = ranges.sliced(with_day(actions, offset_ms), _ORDER, parts)
    so_far = "PARTITION BY uid, slice ORDER BY day, ts_ms, event_id ROWS UNBOUNDED PRECEDING"
    # Both windows are keyed by user and slice and ordered by day first: one shuffle, one sort.
    running = ranges.dealt(rows.drop("goes_on"), parts).selectExpr(
        *_TRACE_KEYS, "day", "slice", "opens", *[f"sum({h}) OVER ({so_far}) AS {c}" for c, h in HITS.items()]
    )
    # Running counts only grow, so the highest one up to two days ago is what has dropped out.
    own = running.selectExpr(
        *_TRACE_KEYS, "day", "slice", "opens", *[f"{c} - coalesce(max({c}) OVER ({_TOO_OLD}), 0) AS {c}" for c in COUNTS]
    )
    # A slice has one opening user at most, so this is a row for each slice at most.
    traced = own.join(F.broadcast(_carried(rows)), F.expr("opens AND slice = _slice AND uid = _uid"), "left")
    return traced.selectExpr(*_TRACE_KEYS, *[
        f"{c} + CASE WHEN day = _day THEN _today_{c} + _yesterday_{c} WHEN day = _day + 1 THEN _today_{c} ELSE 0 END AS {c}"
        for c in COUNTS
    ])


def _carried(rows: DataFrame) -> DataFrame:
    """For the user in whom a slice opens: the first day there, and what earlier slices counted on that day and on
    the day before. Only users at a bound are summed up, by slice and day, before anything moves."""
    totals = rows.where("opens OR goes_on").groupBy("uid", "slice", "day").agg(
        *aggregates(HIT_SUMS), F.bool_or("opens").alias("opens")
    ).repartition("uid")  # which serves all three windows
    earlier = "PARTITION BY uid, day ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    yesterday = "PARTITION BY uid ORDER BY day RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING"
    carried = totals.selectExpr(
        "uid AS _uid", "slice AS _slice", "day AS _day", "opens",
        "min(day) OVER (PARTITION BY uid, slice) AS first_day",
        *[f"coalesce(sum({c}) OVER ({earlier}), 0) AS _today_{c}" for c in COUNTS],
        *[f"coalesce(sum({c}) OVER ({yesterday}), 0) AS _yesterday_{c}" for c in COUNTS],
    )
    return carried.where("opens AND _day = first_day").drop("opens", "first_day")


def own_channel_counts() -> list[str]:
    """The counts of the channel the event belongs to."""
    return [
        f"CASE WHEN channel = {quoted(dims.CLICK_CHANNEL)} THEN {c} ELSE {s} END AS {out}"
        for c, s, out in zip(CLICK_COUNTS, SEARCH_COUNTS, ACTIONS)
    ]


def with_raw_scores(
    counts: DataFrame,
    click_weight: dict[str, int] = dims.CLICK_WEIGHT,
    search_weight: dict[str, int] = dims.SEARCH_WEIGHT,
    biz_weight: dict[str, int] = dims.BIZ_WEIGHT,
) -> DataFrame:
    """Adds the weighted score of each business to a frame with the ten counts."""
    raw = [
        f"{weighted(c, s, click_weight[b], search_weight[b], biz_weight[b])} AS {out}"
        for b, c, s, out in zip(dims.SCORED_BIZ, CLICK_COUNTS, SEARCH_COUNTS, RAW_SCORES)
    ]
    return counts.selectExpr("*", *raw)


def with_scores(raw: DataFrame, on_flat: str = "nan") -> DataFrame:
    """Replaces the weighted scores by their normalised form."""
    return with_softmax(raw, RAW_SCORES, SCORES, on_flat)
