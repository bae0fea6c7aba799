"""Last click or search of every user."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import last_action_text, row_key


def last_action(actions: DataFrame, zone: str | None = None) -> DataFrame:
    """``row_key, user_last_biz, last_ts`` from ``uid, channel, biz, ts_ms, event_id``.

    Aggregates that combine before the shuffle: each input task sends one row per user, channel and business it
    saw. The text is built afterwards, once per user. Works on a stream too (update mode), which takes one aggregate.
    """
    newest = actions if actions.isStreaming else _newest_of_each(actions)
    last = newest.groupBy("uid").agg(
        F.expr("max_by(struct(channel, biz, ts_ms), struct(ts_ms, event_id, channel))").alias("last")
    )
    text = last_action_text("last.channel", "last.biz", "last.ts_ms", zone)
    return last.selectExpr(f"{row_key()} AS row_key", f"{text} AS user_last_biz", "last.ts_ms AS last_ts")


# Time and id as one number of fixed width, so that a maximum is a hash aggregate, where one over structs would sort all
# actions first. Both are shifted to be no less than 0; a timestamp has 15 digits at most (see sources.parse).
_STAMP, _NUMBER, _WIDTH = "1000000000000000BD", "9223372036854775808BD", "18446744073709551616BD"
ORDER_KEY = f"(CAST(ts_ms AS decimal(19, 0)) + {_STAMP}) * {_WIDTH} + (CAST(event_id AS decimal(19, 0)) + {_NUMBER})"


def time_of(key: str) -> str:
    return f"CAST({key} div {_WIDTH} - {_STAMP} AS bigint)"


def _newest_of_each(actions: DataFrame) -> DataFrame:
    """The newest action of each user, channel and business."""
    newest = actions.groupBy("uid", "channel", "biz").agg(F.max(F.expr(ORDER_KEY)).alias("key"))
    return newest.selectExpr(
        "uid", "channel", "biz", f"{time_of('key')} AS ts_ms", f"CAST(key % {_WIDTH} - {_NUMBER} AS bigint) AS event_id"
    )
