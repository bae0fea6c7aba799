"""Rows told apart by the watermark: on time or late, none dropped.

Spark's own operators drop late rows without a trace. A stateful step sees the watermark of its micro-batch
and can mark rows instead; the event time is taken out of the rows before it, or Spark would drop
them there as well.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from labelloom.dims import WATERMARK_DELAY
from labelloom.sources.parse import with_event_time

MARKED = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("watermark_ms", T.LongType()),
    T.StructField("late", T.BooleanType()),
])


class _Marks(StatefulProcessor):
    """Keeps nothing; passes every row on with the watermark it met."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for r in rows:
            yield Row(uid=key[0], ts_ms=r["ts_ms"], event_id=r["event_id"], watermark_ms=watermark, late=r["ts_ms"] <= watermark)

    def close(self) -> None:
        pass


def marked(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """``uid, ts_ms, event_id`` of a stream with ``watermark_ms`` and ``late``: whether the row's time is not above the
    watermark, the newest time of all micro-batches before less ``delay``. Both kinds come out, so a sink can count
    the late ones or keep them apart. A stamp from the future moves the watermark no further than now."""
    timed = with_event_time(rows.select("uid", "ts_ms", "event_id"), delay).select("uid", "ts_ms", "event_id", "event_time")
    return timed.drop("event_time").groupBy("uid").transformWithState(_Marks(), MARKED, outputMode="Append", timeMode="EventTime")
