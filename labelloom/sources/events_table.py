"""The shared ``events`` table seen as the three logs (backfill from a table).

Works on a batch and on a streaming read of the table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.text import quoted_list
from labelloom.schemas import LogSpec

# Declared, so no job has to look at the files first. Read as TIMESTAMP, the zone-free values count
# as UTC whatever the session zone is.
EVENTS_DDL = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"

# Fixed values of the test adapter.
_MODELS = ["terminalModel", "broadbandModel", "packageModel", "cardModel", "familyModel", "xiaomiModel", "otherModel"]
_SHORT_NAMES = ["terminal", "broadband", "package", "number", "family", "xiaomi", "other"]
_BUTTONS = ["点击号码", "点击叉号", "其他"]
_NUMBER_CODES = ["01", "02", "03", "04", "05", "06", "09", "12", "99"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of part files."""
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(EVENTS_DDL).options(**options)
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if location.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(location).isFile():
        # A stream reads folders: the one the file lies in, and there nothing else.
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def _pick(values: list[str], index: str) -> str:
    return f"element_at(array({quoted_list(values)}), int({index}) + 1)"


def _base(events: DataFrame) -> DataFrame:
    # The generator keeps filters on k above it: the JSON text is read once per row.
    return events.selectExpr(
        "string(user_id) AS uid",
        "user_id",
        "unix_millis(ts) AS ts_ms",
        "event_id",
        "explode(array(int(get_json_object(props, '$.k')))) AS k",
    )


def click_log(events: DataFrame) -> DataFrame:
    return _base(events.where("event_type IN ('click', 'signup')")).selectExpr(
        "uid",
        f"{_pick(_MODELS, 'k % 7')} AS biz_type",
        f"{_pick(_BUTTONS, '(k div 7) % 3')} AS pb_name",
        f"{_pick(_NUMBER_CODES, 'user_id % 9')} AS num_type",
        "ts_ms",
        "event_id",
    )


def search_log(events: DataFrame) -> DataFrame:
    return _base(events.where("event_type IN ('purchase', 'error')")).selectExpr(
        "uid AS search_mob",
        f"{_pick(_SHORT_NAMES, 'k % 7')} AS biz_type",
        "CASE user_id % 3 WHEN 0 THEN 'lucky' WHEN 1 THEN 'love' END AS number_type",
        "ts_ms",
        "event_id",
    )


def exposure_log(events: DataFrame) -> DataFrame:
    return _base(events).selectExpr(
        "uid",
        f"{_pick(_MODELS, 'least(k % 9, k % 7)')} AS biz_type",
        "if(k % 4 = 0, '首页-推荐', '首页-专享') AS storey",
        "ts_ms",
        "event_id",
    )


def as_json(log_rows: DataFrame, log: LogSpec, ts: Column | None = None, uid: Column | None = None) -> DataFrame:
    """Rows of a log back as raw JSON lines (``value, event_id``), to feed the parser."""
    fields = [n for n in log.fields.names if n not in ("ts", log.user_field)]
    user = F.col(log.user_field) if uid is None else uid
    stamp = F.col("ts_ms") if ts is None else ts
    record = F.struct(user.alias(log.user_field), *fields, stamp.alias("ts"))
    return log_rows.select(F.to_json(record).alias("value"), "event_id")
