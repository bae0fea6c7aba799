"""Parse a raw log once and keep it typed: all label jobs of a backfill then read narrow columns.

Accepted and rejected lines go into one table, told apart by the partition column ``reject``, so a
reader of either kind touches only its own files. Only rejects keep their raw text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelloom.schemas import LogSpec
from labelloom.sources.parse import parse

_ACCEPTED = "none"


def _rows(raw: DataFrame, log: LogSpec) -> DataFrame:
    parsed = parse(raw, log)
    typed = [c for c in parsed.columns if c not in ("value", "reject")]
    return parsed.selectExpr(
        *typed, "if(reject IS NULL, NULL, value) AS value", f"coalesce(reject, '{_ACCEPTED}') AS reject"
    )


def ingest(raw: DataFrame, log: LogSpec, path: str, batch: str = "all") -> None:
    """Stores the lines as ``batch``. The same batch again replaces what it stored before, so a job that
    is run twice counts nothing twice."""
    # The batch folder is replaced as a whole: kinds of rejects that are gone must not stay behind.
    _rows(raw, log).write.mode("overwrite").partitionBy("reject").parquet(f"{path}/{log.name}/batch={batch}")


def ingest_stream(raw: DataFrame, log: LogSpec, path: str, **trigger) -> StreamingQuery:
    """The same for a live log; Spark's file sink makes every micro-batch visible once."""
    writer = (
        _rows(raw, log)
        .withColumn("batch", F.lit("stream"))
        .writeStream.outputMode("append")
        .partitionBy("batch", "reject")
        .option("checkpointLocation", f"{path}/checkpoints/{log.name}")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.format("parquet").start(f"{path}/{log.name}")


def read_ingested(spark: SparkSession, log: LogSpec, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/{log.name}")
    return rows.where(f"reject = '{_ACCEPTED}'").drop("value", "reject", "batch")


def read_rejects(spark: SparkSession, log: LogSpec, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/{log.name}")
    return rows.where(f"reject <> '{_ACCEPTED}'").selectExpr(f"'{log.name}' AS log", "reject AS reason", "value")
