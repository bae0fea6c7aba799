"""The last exposures of a user and the businesses shown least among them.

A user's queue holds the newest exposures, at most ``length`` of them, and starts afresh after a
pause of ``gap_ms`` or more. Input: ``uid, biz, ts_ms, event_id`` with no NULL business.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import dims
from labelloom.functions.text import quoted
from labelloom.operators import ranges

COUNTS = [f"n_{biz}" for biz in dims.EXPOSED_BIZ]
_NEWEST_FIRST = "PARTITION BY uid ORDER BY ts_ms DESC, event_id DESC"


def latest_queue(exposures: DataFrame, length: int = dims.QUEUE_LENGTH, gap_ms: int = dims.IDLE_GAP_MS) -> DataFrame:
    """The queue entries of every user after their last exposure; ``age`` 1 is the newest.

    Each input task keeps only its newest ``length`` rows of a user before the shuffle (a rank
    filter Spark pushes down as a group limit), so no user can fill a task.
    """
    recent = exposures.selectExpr("*", f"row_number() OVER ({_NEWEST_FIRST}) AS age").where(f"age <= {length}")
    paused = recent.selectExpr(
        "*", f"coalesce(lag(ts_ms) OVER ({_NEWEST_FIRST}) - ts_ms >= {gap_ms}L, false) AS paused"
    )
    cut = paused.selectExpr("*", f"max(paused) OVER ({_NEWEST_FIRST} ROWS UNBOUNDED PRECEDING) AS expired")
    return cut.where("NOT expired").drop("paused", "expired")


def latest_counts(exposures: DataFrame, length: int = dims.QUEUE_LENGTH, gap_ms: int = dims.IDLE_GAP_MS) -> DataFrame:
    """``uid, last_ts``, the count of each business in the queue and ``number_first``."""

    def oldest_age(biz: str) -> str:
        # A missing business counts as older than any entry.
        return f"coalesce(max(CASE WHEN biz = '{biz}' THEN age END), {length + 1})"

    return latest_queue(exposures, length, gap_ms).groupBy("uid").agg(
        F.expr("max(ts_ms) AS last_ts"),
        *[F.expr(f"count(CASE WHEN biz = {quoted(b)} THEN 1 END) AS n_{b}") for b in dims.EXPOSED_BIZ],
        F.expr(f"{oldest_age('number')} <= {oldest_age('xiaomi')} AS number_first"),
    )


def counts_of_array(queue: str = "queue") -> list[str]:
    """The same columns for a queue held as an array of businesses, oldest first."""
    return [
        *[f"bigint(size({queue}) - size(array_remove({queue}, {quoted(b)}))) AS n_{b}" for b in dims.EXPOSED_BIZ],
        # The one whose first entry is later leads; a missing one has position 0.
        f"array_position({queue}, 'number') >= array_position({queue}, 'xiaomi') AS number_first",
    ]


def is_padded(pad_below: int = dims.PAD_BELOW) -> str:
    """Whether businesses missing from the queue take part with a count of 0."""
    return f"({' + '.join(f'int({c} > 0)' for c in COUNTS)} < {pad_below})"


def _in_order(pick) -> list[str]:
    """``pick(biz)`` for every business, in the order that decides between equal counts."""
    a, b, *others = map(pick, dims.EXPOSED_ORDER)
    return [f"if(number_first, {a}, {b})", f"if(number_first, {b}, {a})", *others]


def least_text(pad_below: int = dims.PAD_BELOW) -> str:
    """``a,b``: the two businesses shown least."""

    def entry(biz: str) -> str:
        # A business that takes no part sorts last; at least five always do.
        n = f"if({is_padded(pad_below)} OR n_{biz} > 0, n_{biz}, {1 << 62}L)"
        return f"named_struct('n', {n}, 'biz', {quoted(biz)})"

    def place(i: int, e: str) -> str:
        return f"named_struct('n', {e}.n, 'place', {i}, 'biz', {e}.biz)"

    ranked = ", ".join(place(i, e) for i, e in enumerate(_in_order(entry)))
    return f"concat_ws(',', slice(array_sort(array({ranked})), 1, 2).biz)"


def history_text(pad_below: int = dims.PAD_BELOW) -> str:
    """``biz:count`` of every business that takes part."""

    def entry(biz: str) -> str:
        return f"if({is_padded(pad_below)} OR n_{biz} > 0, concat({quoted(biz + ':')}, n_{biz}), NULL)"

    return f"concat_ws(',', {', '.join(_in_order(entry))})"


def gap_groups(exposures: DataFrame, gap_ms: int = dims.IDLE_GAP_MS) -> DataFrame:
    """``uid, groups``: how often a user's queue started, the first start included.

    Two events in the same ``gap_ms``-wide bucket are never a pause apart, so the first and last
    event of each bucket are enough. They combine before the shuffle.
    """
    ends = exposures.groupBy("uid", F.expr(f"ts_ms div {gap_ms}L AS bucket")).agg(
        F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts")
    )
    before = "lag(last_ts) OVER (PARTITION BY uid ORDER BY bucket)"
    starts = ends.selectExpr("uid", f"coalesce(int(first_ts - {before} >= {gap_ms}L), 1) AS starts")
    return starts.groupBy("uid").agg(F.sum("starts").alias("groups"))


_ORDER = ["uid", "ts_ms", "event_id"]


def queue_trace(
    exposures: DataFrame, length: int = dims.QUEUE_LENGTH, gap_ms: int = dims.IDLE_GAP_MS, parts: int | None = None
) -> DataFrame:
    """``uid, ts_ms, event_id, queue``: the queue (oldest first) after every exposure.

    The exposures are cut into ``parts`` slices of about equal length along ``(uid, ts_ms, event_id)``, whoever
    they belong to, and move once. A slice that opens within a user is given that user's ``length - 1``
    exposures before it, which is all that a queue can hold of them, pauses included.
    """
    rows = ranges.sliced(exposures.select("uid", "biz", "ts_ms", "event_id"), _ORDER, parts)
    led = rows.selectExpr("uid", "biz", "ts_ms", "event_id", "slice", "false AS lead_in").unionByName(_lead_in(rows, length))
    return _queues(ranges.dealt(led, parts), length, gap_ms)


def _queues(rows: DataFrame, length: int, gap_ms: int) -> DataFrame:
    in_time = "PARTITION BY uid, slice ORDER BY ts_ms, event_id"
    numbered = rows.selectExpr(
        "*",
        f"row_number() OVER ({in_time}) AS place",
        f"ts_ms - lag(ts_ms) OVER ({in_time}) >= {gap_ms}L AS paused",
    )
    framed = numbered.selectExpr(
        "*",
        f"max(CASE WHEN paused THEN place END) OVER ({in_time} ROWS UNBOUNDED PRECEDING) AS start",
        f"collect_list(biz) OVER ({in_time} ROWS {length - 1} PRECEDING) AS recent",
    )
    size = "least(place - coalesce(start, 1) + 1, size(recent))"
    return framed.where("NOT lead_in").selectExpr("uid", "ts_ms", "event_id", f"slice(recent, -{size}, {size}) AS queue")


def _lead_in(rows: DataFrame, length: int) -> DataFrame:
    """For the user in whom a slice opens, the last ``length - 1`` exposures before it, as extra rows of that slice.

    Of each user at a bound every slice gives its newest ``length - 1`` exposures; those of two neighbours merge into
    the newest of both, whatever comes first, so the windows below see a few rows for each slice. Input tasks keep
    no more than these either, a rank filter that Spark applies before the shuffle.
    """
    newest_first = "PARTITION BY uid, slice ORDER BY ts_ms DESC, event_id DESC"
    tails = rows.where("opens OR goes_on").selectExpr("*", f"row_number() OVER ({newest_first}) AS age").where(f"age < {length}")
    in_time = "PARTITION BY uid ORDER BY ts_ms, event_id"
    marked = tails.selectExpr(
        "uid",
        "slice",
        f"opens AND coalesce(lag(slice) OVER ({in_time}), slice) <> slice AS first",
        f"collect_list(struct(biz, ts_ms, event_id)) OVER ({in_time} ROWS BETWEEN {length - 1} PRECEDING"
        " AND 1 PRECEDING) AS before",
    )
    return marked.where("first").selectExpr("uid", "inline(before)", "slice", "true AS lead_in").select(
        "uid", "biz", "ts_ms", "event_id", "slice", "lead_in"
    )
