"""JSON log lines to typed rows; what cannot be used goes to a counted reject frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.dims import WATERMARK_DELAY
from labelloom.schemas import LogSpec

_BAD = "_unparsed"
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
}


def parse(raw: DataFrame, log: LogSpec) -> DataFrame:
    """``value, event_id`` -> the log's fields, ``ts_ms`` and ``reject`` (NULL for a usable row).

    All fields are read as strings, so a number where text is expected (or the reverse) is
    accepted; ``ts_ms`` is the whole part of ``ts`` and NULL unless that is a number of at most 15 digits
    (in plain or exponent form). The parsed object comes out of a generator, which keeps later filters
    from being pushed below it and parsing each line again.
    """
    fields = T.StructType([*log.fields.fields, T.StructField(_BAD, T.StringType())])
    parsed = raw.select("value", "event_id", F.inline(F.array(F.from_json("value", fields, _JSON_OPTIONS))))
    # Producers that keep time in floating point write 1.7e12; a double holds such numbers exactly.
    number = F.col("ts").try_cast("double")
    ts_ms = F.coalesce(F.col("ts").try_cast("bigint"), F.when(F.abs(number) < 1e15, number.cast("bigint")))
    reject = (
        F.when(F.col("value").isNull() | (F.trim("value") == "") | F.col(_BAD).isNotNull(), "malformed")
        .when(F.col(log.user_field).isNull(), "no_user")
        .when(ts_ms.isNull(), "bad_ts")
    )
    names = [n for n in log.fields.names if n != "ts"]
    return parsed.select(*names, ts_ms.alias("ts_ms"), "event_id", "value", reject.alias("reject"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject").isNull()).drop("value", "reject")


def rejects(parsed: DataFrame, log: LogSpec) -> DataFrame:
    """``log, reason, value`` of every line that was dropped."""
    return parsed.where(F.col("reject").isNotNull()).select(
        F.lit(log.name).alias("log"), F.col("reject").alias("reason"), "value"
    )


def read_log(raw: DataFrame, log: LogSpec) -> DataFrame:
    return accepted(parse(raw, log))


def with_event_time(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Adds ``event_time`` and its watermark. Put it on each log before a union: the slower log
    then sets the pace and no row of it is dropped because the other one is ahead.

    A stamp from the future counts as now: one wrong clock must not close the days of everybody else.
    ``ts_ms`` keeps what was logged."""
    stamp = F.timestamp_millis("ts_ms")
    if rows.isStreaming:
        stamp = F.least(stamp, F.current_timestamp())
    return rows.withColumn("event_time", stamp).withWatermark("event_time", delay)
