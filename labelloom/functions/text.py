"""Label names and label payloads, as SQL expressions over the named columns."""

from collections.abc import Iterable


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(values: Iterable[str]) -> str:
    return ", ".join(map(quoted, values))


def null_text(value: str) -> str:
    """A missing value is written as the word ``null`` inside names and payloads."""
    return f"coalesce({value}, 'null')"


def lookup(names: dict[str, str], key: str) -> str:
    """Dictionary lookup, NULL on a miss."""
    return f"map({quoted_list(x for pair in names.items() for x in pair)})[{key}]"


def row_key(uid: str = "uid") -> str:
    return f"md5({uid})"


def clock_text(ts_ms: str, zone: str | None = None) -> str:
    """``yyyyMMddHHmmss`` of an epoch-ms column, in ``zone`` or else in the session zone."""
    if zone is None:
        return f"date_format(timestamp_millis({ts_ms}), 'yyyyMMddHHmmss')"
    # Zone-free timestamps all the way, read off their text form: the session zone has no say.
    utc = f"timestampadd(MILLISECOND, {ts_ms}, timestamp_ntz'1970-01-01 00:00:00')"
    local = f"cast(convert_timezone('UTC', {quoted(zone)}, {utc}) AS string)"
    return f"translate(substring({local}, 1, 19), '-: ', '')"


def last_action_text(channel: str, biz: str, ts_ms: str, zone: str | None = None) -> str:
    """``click,code,<biz>,<time>`` or ``search,app,<biz>,<time>``."""
    origin = f"CASE WHEN {channel} = 'click' THEN 'code' ELSE 'app' END"
    return f"concat_ws(',', {channel}, {origin}, {null_text(biz)}, {clock_text(ts_ms, zone)})"


def scores_text(scores: list[str]) -> str:
    return f"format_string({quoted(','.join(['%.5f'] * len(scores)))}, {', '.join(scores)})"


def counts_text(counts: list[str]) -> str:
    return f"format_string({quoted(','.join(['%d'] * len(counts)))}, {', '.join(counts)})"
