"""Ever-growing counters per user and label."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import row_key


def count_labels(labelled: DataFrame) -> DataFrame:
    """``row_key, label, n, last_ts`` from ``uid, label, ts_ms``.

    The counts are combined before the shuffle, so a user with a large share of the rows costs
    one row per label and input task. The key is hashed after grouping, once per result row.
    Works on a stream too (update mode); the counts are absolute, so writing them again is safe.
    """
    counts = labelled.groupBy("uid", "label").agg(F.count("*").alias("n"), F.max("ts_ms").alias("last_ts"))
    return counts.selectExpr(f"{row_key()} AS row_key", "label", "n", "last_ts")
