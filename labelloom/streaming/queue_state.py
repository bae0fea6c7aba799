"""The last exposures of a user as streaming state."""

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ENTRY = T.StructType([
    T.StructField("ts_ms", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("biz", T.StringType()),
])
OUTPUT = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("last_ts", T.LongType()),
    T.StructField("queue", T.ArrayType(T.StringType())),
    T.StructField("entries", T.ArrayType(ENTRY)),
])
TRIMMED = "uid string, biz string, ts_ms bigint, event_id bigint"


def keep_newest(length: int):
    """Map-side trim: of each Arrow batch only the newest ``length`` rows of a user go on, so a
    very active user cannot flood one state task. No newer row is lost by it. Ids stay whole numbers, a
    missing one is older than all others of its time."""

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [("uid", "ascending"), ("ts_ms", "descending"), ("event_id", "descending")]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.take(pc.sort_indices(pa.table(batch), sort_keys=keys, null_placement="at_end"))
            users = rows.column("uid").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, users[1:] != users[:-1]])
            age = np.arange(len(users)) - np.repeat(first, np.diff(np.r_[first, len(users)]))
            yield rows.filter(pa.array(age < length))

    return trim


def _in_order(entry: tuple) -> tuple:
    """Sorts entries by time, then id, a missing one first."""
    ts_ms, event_id, biz = entry
    return ts_ms, event_id is not None, event_id or 0, biz


class LastExposures(StatefulProcessor):
    """Keeps the newest ``length`` exposures of a user and emits the queue after every micro-batch.

    By event time, entries older than a pause stay in the state and are cut when the queue is
    emitted: a late event may still close the pause, and the result is the one of the batch form
    for any order of arrival. With ``forgets`` a user idle for ``gap_ms`` is forgotten by an event-time timer.

    By the wall clock, the state itself expires when nothing arrives for ``gap_ms``; pauses inside
    the data play no part.
    """

    def __init__(self, length: int, gap_ms: int, wall_clock: bool = False, forgets: bool = True):
        self._length, self._gap_ms, self._wall_clock = length, gap_ms, wall_clock
        self._forgets = forgets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        ttl = self._gap_ms if self._wall_clock else None
        self._entries = handle.getListState("entries", ENTRY, ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = [tuple(e) for e in self._entries.get()]
        arrived = ((r["ts_ms"], r["event_id"], r["biz"]) for r in rows)
        newest = heapq.nlargest(self._length, chain(known, arrived), key=_in_order)[::-1]
        self._entries.put(newest)
        last_ts, start = newest[-1][0], 0
        if not self._wall_clock:
            if self._forgets:
                self._move_timer(known[-1][0] if known else None, last_ts)
            pauses = (i for i in range(1, len(newest)) if newest[i][0] - newest[i - 1][0] >= self._gap_ms)
            start = max(pauses, default=0)
        yield Row(uid=key[0], last_ts=last_ts, queue=[e[2] for e in newest[start:]], entries=newest)

    def _move_timer(self, before: int | None, last_ts: int) -> None:
        if before == last_ts:
            return
        if before is not None:
            self._handle.deleteTimer(before + self._gap_ms)
        self._handle.registerTimer(last_ts + self._gap_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._entries.clear()
        return iter(())

    def close(self) -> None:
        pass
