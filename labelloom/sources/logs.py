"""Raw log readers, as a stream or as a batch.

Every reader gives ``value STRING`` and ``event_id BIGINT``, a tie-breaker for events of one
user with the same timestamp.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PARTITION_BITS = 16


def kafka_options(
    servers: str,
    topic: str,
    *,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    sasl_jaas_config: str | None = None,
    **reader_options: str,
) -> dict[str, str]:
    """Options of Spark's Kafka reader. New partitions are found by Spark in every micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    client = {
        "kafka.security.protocol": security_protocol,
        "kafka.sasl.mechanism": sasl_mechanism,
        "kafka.sasl.jaas.config": sasl_jaas_config,
    }
    options.update({k: v for k, v in client.items() if v})
    options.update(reader_options)
    return options


def _kafka_columns(df: DataFrame) -> DataFrame:
    order: Column = F.shiftleft("offset", _PARTITION_BITS).bitwiseOR(F.col("partition").cast("long"))
    return df.select(F.col("value").cast("string").alias("value"), order.alias("event_id"))


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Live log, from the newest offsets unless the options say otherwise."""
    reader = spark.readStream.format("kafka").options(**{"startingOffsets": "latest", **options})
    return _kafka_columns(reader.load())


def kafka_backfill(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same topic as a batch, from the oldest offsets unless the options say otherwise."""
    reader = spark.read.format("kafka").options(**{"startingOffsets": "earliest", **options})
    return _kafka_columns(reader.load())


def _file_columns(df: DataFrame) -> DataFrame:
    if "event_id" in df.columns:
        return df.select("value", F.col("event_id").cast("long").alias("event_id"))
    # Plain lines carry no tie-breaker of their own; a content hash is at least the same on a rerun.
    return df.select("value", F.xxhash64("value").alias("event_id"))


def file_stream(spark: SparkSession, path: str, fmt: str = "text", **options: str) -> DataFrame:
    """Files that arrive in a folder: JSON lines (``text``) or tables with value and event_id."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "text":
        reader = reader.schema("value string, event_id bigint")
    return _file_columns(reader.load(path))


def file_backfill(spark: SparkSession, path: str, fmt: str = "text", **options: str) -> DataFrame:
    return _file_columns(spark.read.format(fmt).options(**options).load(path))
