"""Calendar days of an epoch-ms column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelloom.dims import DAY_MS, DAY_OFFSET_MS


def day_number(ts_ms: str, offset_ms: int = DAY_OFFSET_MS) -> str:
    """SQL for the number of the calendar day in a zone ``offset_ms`` ahead of UTC."""
    return f"(({ts_ms} + {offset_ms}L) div {DAY_MS}L)"


def day_window(event_time: str, days: int = 1, offset_ms: int = DAY_OFFSET_MS) -> Column:
    """Spark window of ``days`` whole calendar days, one starting every day."""
    start_ms = (DAY_MS - offset_ms) % DAY_MS
    return F.window(event_time, f"{days} days", "1 day", f"{start_ms} milliseconds")
