"""Declared schemas. JSON fields are all strings; ``ts`` is cast after parsing (see sources.parse)."""

from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@dataclass(frozen=True)
class LogSpec:
    """One kind of JSON log: its fields and which of them holds the user."""

    name: str
    user_field: str
    fields: T.StructType


CLICK = LogSpec("click", "uid", _strings("uid", "biz_type", "pb_name", "num_type", "ts"))
SEARCH = LogSpec("search", "search_mob", _strings("search_mob", "biz_type", "number_type", "ts"))
EXPOSURE = LogSpec("exposure", "uid", _strings("uid", "biz_type", "storey", "ts"))
LOGS = (CLICK, SEARCH, EXPOSURE)

# One cell per user and label; expire_ts NULL means the cell never expires.
LABELS = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("write_ts", T.LongType()),
    T.StructField("expire_ts", T.LongType()),
])
LABEL_COLUMNS = LABELS.names
