"""DuckDB SQL for the registered queries, written from the semantics and not from the Spark plans:
everything per event is a window over the raw rows, and "latest" is the last row of a trace."""

_EV = """
ev AS (
  SELECT event_id, user_id, event_type, CAST(user_id AS VARCHAR) AS uid,
         epoch_us(ts) // 1000 AS ts_ms,  -- whole milliseconds; epoch_ms() rounds in newer DuckDB versions
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
click_log AS (
  SELECT uid, ts_ms, event_id,
         ['terminalModel','broadbandModel','packageModel','cardModel','familyModel','xiaomiModel','otherModel'][k % 7 + 1] AS biz_type,
         ['点击号码','点击叉号','其他'][(k // 7) % 3 + 1] AS pb_name,
         ['01','02','03','04','05','06','09','12','99'][user_id % 9 + 1] AS num_type
  FROM ev WHERE event_type IN ('click','signup')),
search_log AS (
  SELECT uid AS search_mob, ts_ms, event_id,
         ['terminal','broadband','package','number','family','xiaomi','other'][k % 7 + 1] AS biz_type,
         CASE user_id % 3 WHEN 0 THEN 'lucky' WHEN 1 THEN 'love' END AS number_type
  FROM ev WHERE event_type IN ('purchase','error')),
exposure_log AS (
  SELECT uid, ts_ms, event_id,
         CASE WHEN k % 4 = 0 THEN '首页-推荐' ELSE '首页-专享' END AS storey,
         ['terminalModel','broadbandModel','packageModel','cardModel','familyModel','xiaomiModel','otherModel'][least(k % 9, k % 7) + 1] AS biz_type
  FROM ev)"""

_BIZ = """CASE biz_type WHEN 'terminalModel' THEN 'terminal' WHEN 'broadbandModel' THEN 'broadband'
         WHEN 'packageModel' THEN 'package' WHEN 'cardModel' THEN 'number' WHEN 'familyModel' THEN 'family'
         WHEN 'xiaomiModel' THEN 'xiaomi' END"""
_SCORED_BIZ = f"nullif({_BIZ}, 'xiaomi')"
_NUMBER_TYPE = """CASE num_type WHEN '01' THEN 'birthday' WHEN '02' THEN 'family' WHEN '03' THEN 'lucky'
         WHEN '04' THEN 'love' WHEN '05' THEN 'student' WHEN '06' THEN 'rare' WHEN '09' THEN 'bless'
         WHEN '12' THEN 'area' END"""
_FIVE = ["terminal", "broadband", "package", "number", "family"]
_SIX = _FIVE + ["xiaomi"]

_CARDS = f"""
cards AS (
  SELECT uid, ts_ms, event_id,
         coalesce({_NUMBER_TYPE}, 'null') || CASE pb_name WHEN '点击号码' THEN '_clicks' ELSE '_x' END AS label
  FROM click_log WHERE biz_type = 'cardModel' AND pb_name IN ('点击号码', '点击叉号'))"""
_NUMBERS = """
numbers AS (
  SELECT search_mob AS uid, ts_ms, event_id, coalesce(number_type, 'null') || '_searchs' AS label
  FROM search_log WHERE biz_type = 'number')"""


def _sql(*ctes: str, select: str) -> str:
    return "WITH " + ",".join([_EV, *ctes]) + "\n" + select


def _actions(biz: str) -> str:
    return f"""
actions AS (
  SELECT uid, 'click' AS channel, {biz} AS biz, ts_ms, event_id, (ts_ms + 28800000) // 86400000 AS day FROM click_log
  UNION ALL
  SELECT search_mob, 'search', biz_type, ts_ms, event_id, (ts_ms + 28800000) // 86400000 FROM search_log)"""


def _hit(channel: str, biz: str) -> str:
    return f"CASE WHEN channel = '{channel}' AND biz = '{biz}' THEN 1 ELSE 0 END"


_TRACE = (
    "\ntrace AS (\n  SELECT uid, channel, ts_ms, event_id, day,\n"
    + ",\n".join(
        f"         CAST(sum({_hit(c, b)}) OVER today + coalesce(sum({_hit(c, b)}) OVER yesterday, 0) AS BIGINT) AS {c}_{b}"
        for c in ("click", "search")
        for b in _FIVE
    )
    + """
  FROM actions
  WINDOW today AS (PARTITION BY uid, day ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         yesterday AS (PARTITION BY uid ORDER BY day RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING))"""
)


def _scores(source: str, weights: dict | None = None) -> str:
    """CTEs raw, stats, exps, scored over a trace-like source."""
    raw = []
    for b in _FIVE:
        c, s, w = (weights[k][b] for k in ("click_weight", "search_weight", "biz_weight")) if weights else (1, 1, 1)
        raw.append(f"(click_{b} * {c} + search_{b} * {s}) * {w} AS raw_{b}")
    mean = " + ".join(f"raw_{b}" for b in _FIVE)
    var = " + ".join(f"(raw_{b} - mean) * (raw_{b} - mean)" for b in _FIVE)
    exps = ", ".join(f"CASE WHEN std > 0 THEN exp((raw_{b} - mean) / std) END AS e_{b}" for b in _FIVE)
    total = " + ".join(f"e_{b}" for b in _FIVE)
    scored = ", ".join(f"e_{b} / ({total}) AS score_{b}" for b in _FIVE)
    return f"""
raw AS (SELECT *, {", ".join(raw)} FROM {source}),
means AS (SELECT *, CAST({mean} AS DOUBLE) / 5 AS mean FROM raw),
stats AS (SELECT *, sqrt(({var}) / 5) AS std FROM means),
exps AS (SELECT *, {exps} FROM stats),
scored AS (SELECT *, {scored} FROM exps)"""


def _last(source: str, name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, event_id DESC, channel DESC) = 1)"""


_ROUNDED = "CASE WHEN std > 0 THEN 0 ELSE 1 END AS flat, " + ", ".join(
    f"round(coalesce(score_{b}, 0.0), 5) AS score_{b}" for b in _FIVE
)
_SCORE_TEXT = (
    "CASE WHEN std > 0 THEN " + " || ',' || ".join(f"printf('%.5f', score_{b})" for b in _FIVE)
    + " ELSE 'NaN,NaN,NaN,NaN,NaN' END"
)


def _count_text(channel: str) -> str:
    return " || ',' || ".join(f"{channel}_{b}" for b in _FIVE)


_LAST_TEXT = """CASE channel WHEN 'click' THEN 'click,code,' ELSE 'search,app,' END || coalesce(biz, 'null') || ','
         || strftime(make_timestamp(ts_ms * 1000), '%Y%m%d%H%M%S')"""

_SHOWN = f"""
shown AS (
  SELECT * FROM (SELECT uid, {_BIZ} AS biz, ts_ms, event_id FROM exposure_log WHERE storey = '首页-专享')
  WHERE biz IS NOT NULL)"""


def _queues(gap_ms: int = 604800000) -> str:
    return f"""
paused AS (
  SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY uid ORDER BY ts_ms, event_id) >= {gap_ms} THEN 1 ELSE 0 END AS p
  FROM shown),
runs AS (SELECT *, sum(p) OVER (PARTITION BY uid ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS run FROM paused),
queues AS (
  SELECT uid, ts_ms, event_id, run, 'x' AS channel,
         list(biz) OVER (PARTITION BY uid, run ORDER BY ts_ms, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS q
  FROM runs)"""


def _queue_texts(pad_below: int = 5, source: str = "last_queue", key: str = "uid") -> str:
    """CTEs entries (one row per queue and business taking part) and texts, one row per queue."""
    place = {"package": 2, "broadband": 3, "terminal": 4, "family": 5}
    whens = " ".join(f"WHEN '{b}' THEN {p}" for b, p in place.items())
    first = "coalesce(list_position(q, '{}'), 0)".format
    return f"""
names AS (SELECT unnest(['terminal','broadband','package','number','family','xiaomi']) AS biz),
entries AS (
  SELECT uid, event_id, ts_ms, names.biz, len(list_filter(q, lambda x: x = names.biz)) AS n,
         CASE names.biz {whens}
           WHEN 'number' THEN CASE WHEN {first('number')} >= {first('xiaomi')} THEN 0 ELSE 1 END
           WHEN 'xiaomi' THEN CASE WHEN {first('xiaomi')} > {first('number')} THEN 0 ELSE 1 END END AS place
  FROM {source}, names
  WHERE list_contains(q, names.biz) OR len(list_distinct(q)) < {pad_below}),
texts AS (
  SELECT {key}, md5(any_value(uid)) AS row_key, max(ts_ms) AS ts_ms,
         string_agg(biz || ':' || n, ',' ORDER BY place) AS expose_biz_his,
         array_to_string(list(biz ORDER BY n, place)[1:2], ',') AS expose_least_biz_7d
  FROM entries GROUP BY {key})"""


_LAST_QUEUE = _last("queues", "last_queue")


def _all_labels() -> list[str]:
    return [
        _CARDS, _NUMBERS, _actions(_SCORED_BIZ), _TRACE, _scores("trace"),
        _last("scored", "last_any"), _last("trace", "last_click", "channel = 'click'"),
        _last("trace", "last_search", "channel = 'search'"),
        _actions(_BIZ).replace("\nactions AS", "\nall_actions AS"), _last("all_actions", "last_action"),
        _SHOWN, _queues(), _LAST_QUEUE, _queue_texts(),
        f"""
label_rows AS (
  SELECT md5(uid) AS row_key, label, CAST(count(*) AS VARCHAR) AS value, CAST(-1 AS BIGINT) AS expire_ts
  FROM (SELECT * FROM cards UNION ALL SELECT * FROM numbers) GROUP BY uid, label
  UNION ALL SELECT md5(uid), 'user_last_biz', {_LAST_TEXT}, ts_ms + 120000 FROM last_action
  UNION ALL SELECT md5(uid), 'biz_score', {_SCORE_TEXT}, ts_ms + 172800000 FROM last_any
  UNION ALL SELECT md5(uid), 'biz_click', {_count_text('click')}, ts_ms + 172800000 FROM last_click
  UNION ALL SELECT md5(uid), 'biz_search', {_count_text('search')}, ts_ms + 172800000 FROM last_search
  UNION ALL SELECT row_key, 'expose_least_biz_7d', expose_least_biz_7d, ts_ms + 604800000 FROM texts
  UNION ALL SELECT row_key, 'expose_biz_his', expose_biz_his, ts_ms + 604800000 FROM texts)""",
    ]


def _rejects() -> str:
    parts = [
        f"""SELECT '{log}' AS log,
       CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'no_user' WHEN event_id % 83 = 0 THEN 'bad_ts' END AS reason
  FROM {log}_log"""
        for log in ("click", "search", "exposure")
    ]
    union = "\n  UNION ALL ".join(parts)
    return _sql(select=f"""SELECT log, reason, count(*) AS n FROM ({union}) WHERE reason IS NOT NULL GROUP BY log, reason""")


def build() -> dict[str, str]:
    from labelloom.dims import KNOWN_LABELS
    from labelloom.plans.queries import TEST_WEIGHTS

    scored = _actions(_SCORED_BIZ)
    queue_text = "SELECT event_id, array_to_string(q, ',') AS queue FROM queues"
    counts = ", ".join(f"len(list_filter(q, x -> x = '{b}')) AS n_{b}" for b in _SIX).replace("x -> x", "lambda x: x")
    return {
        "parse_click_log": _sql(select=f"SELECT uid, {_BIZ} AS biz, ts_ms, event_id FROM click_log WHERE event_id % 97 <> 0"),
        "parse_search_log": _sql(select="SELECT search_mob AS uid, biz_type AS biz, ts_ms, event_id FROM search_log WHERE event_id % 97 <> 0"),
        "parse_exposure_log": _sql(select=f"SELECT uid, {_BIZ} AS biz, ts_ms, event_id FROM exposure_log WHERE event_id % 97 <> 0"),
        "backfill_logs": _sql(select="""SELECT log, count(*) AS rows FROM (SELECT 'click' AS log FROM click_log
  UNION ALL SELECT 'search' FROM search_log UNION ALL SELECT 'exposure' FROM exposure_log) GROUP BY log"""),
        "parse_rejects": _rejects(),
        "lenient_ts_cast": _sql(select="SELECT event_id, ts_ms FROM click_log"),
        "event_time_watermark": _sql(select="SELECT event_id, ts_ms AS event_ms FROM click_log"),
        "biz_dictionary": _sql(select=f"""SELECT biz_type AS raw, coalesce({_BIZ}, 'null') AS mapped,
  coalesce({_SCORED_BIZ}, 'null') AS mapped_for_score, count(*) AS n FROM exposure_log GROUP BY ALL"""),
        "number_type_dictionary": _sql(select=f"""SELECT num_type AS raw, coalesce({_NUMBER_TYPE}, 'null') AS mapped,
  count(*) AS n FROM click_log GROUP BY ALL"""),
        "card_click_classified": _sql(_CARDS, select="SELECT uid, label, ts_ms, event_id FROM cards"),
        "number_search_filtered": _sql(_NUMBERS, select="SELECT uid, label, ts_ms, event_id FROM numbers"),
        "exclusive_exposures": _sql(_SHOWN, select="SELECT uid, biz, event_id FROM shown"),
        "unmapped_exposures": _sql(select=f"""SELECT uid, count(*) AS n FROM exposure_log
  WHERE storey = '首页-专享' AND {_BIZ} IS NULL GROUP BY uid"""),
        "user_row_key": _sql(select="SELECT DISTINCT uid, md5(uid) AS row_key FROM ev"),
        "number_click_counts": _sql(_CARDS, select="""SELECT md5(uid) AS row_key, label, count(*) AS n FROM cards
  WHERE ends_with(label, '_clicks') GROUP BY uid, label"""),
        "number_x_counts": _sql(_CARDS, select="""SELECT md5(uid) AS row_key, label, count(*) AS n FROM cards
  WHERE ends_with(label, '_x') GROUP BY uid, label"""),
        "number_search_counts": _sql(_NUMBERS, select="SELECT md5(uid) AS row_key, label, count(*) AS n FROM numbers GROUP BY uid, label"),
        "last_biz": _sql(_actions(_BIZ), _last("actions", "last_action"),
                         select=f"SELECT md5(uid) AS row_key, {_LAST_TEXT} AS user_last_biz FROM last_action"),
        "co_keyed_channels": _sql(scored, select="""SELECT uid, count(*) FILTER (channel = 'click') AS n_click,
  count(*) FILTER (channel = 'search') AS n_search FROM actions GROUP BY uid"""),
        "daily_biz_counts": _sql(scored, select="SELECT uid, day, channel, biz, count(*) AS n FROM actions GROUP BY ALL"),
        "biz_actions_trace": _sql(scored, _TRACE, select="SELECT event_id, channel, " + ", ".join(
            f"CASE channel WHEN 'click' THEN click_{b} ELSE search_{b} END AS action_{b}" for b in _FIVE) + " FROM trace"),
        "biz_raw_score_trace": _sql(scored, _TRACE, _scores("trace"),
                                    select="SELECT event_id, " + ", ".join(f"raw_{b}" for b in _FIVE) + " FROM raw"),
        "biz_weighted_score_trace": _sql(scored, _TRACE, _scores("trace", TEST_WEIGHTS),
                                         select="SELECT event_id, " + ", ".join(f"raw_{b}" for b in _FIVE) + " FROM raw"),
        "biz_score_trace": _sql(scored, _TRACE, _scores("trace"), select=f"SELECT event_id, {_ROUNDED} FROM scored"),
        "biz_score_trace_uniform": _sql(scored, _TRACE, _scores("trace"), select="SELECT event_id, " + ", ".join(
            f"round(coalesce(score_{b}, 0.2), 5) AS score_{b}" for b in _FIVE) + " FROM scored"),
        "biz_score_latest": _sql(scored, _TRACE, _scores("trace"), _last("scored", "last_any"),
                                 select=f"SELECT md5(uid) AS row_key, {_ROUNDED} FROM last_any"),
        "biz_click_label": _sql(scored, _TRACE, _last("trace", "last_click", "channel = 'click'"),
                                select=f"SELECT md5(uid) AS row_key, {_count_text('click')} AS biz_click FROM last_click"),
        "biz_search_label": _sql(scored, _TRACE, _last("trace", "last_search", "channel = 'search'"),
                                 select=f"SELECT md5(uid) AS row_key, {_count_text('search')} AS biz_search FROM last_search"),
        "biz_score_label": _sql(scored, _TRACE, _scores("trace"), _last("scored", "last_any"),
                                select=f"SELECT md5(uid) AS row_key, {_SCORE_TEXT} AS biz_score FROM last_any"),
        "expose_last12_trace": _sql(_SHOWN, _queues(), select=queue_text),
        "expose_last12_trace_short_gap": _sql(_SHOWN, _queues(172800000), select=queue_text),
        "expose_gap_groups": _sql(_SHOWN, _queues(172800000), select="SELECT uid, CAST(max(run) + 1 AS BIGINT) AS groups FROM queues GROUP BY uid"),
        "expose_counts_trace": _sql(_SHOWN, _queues(), select=f"""SELECT event_id, {counts},
  CASE WHEN len(list_distinct(q)) < 5 THEN 1 ELSE 0 END AS padded FROM queues"""),
        "biz_label_trace": _sql(scored, _TRACE, _scores("trace"), select=f"""SELECT event_id, md5(uid) AS row_key,
  'biz_' || channel AS label, CASE channel WHEN 'click' THEN {_count_text('click')} ELSE {_count_text('search')} END AS counts,
  {_SCORE_TEXT} AS biz_score FROM scored"""),
        "expose_label_trace": _sql(_SHOWN, _queues(), _queue_texts(source="queues", key="event_id"),
                                   select="SELECT event_id, row_key, expose_least_biz_7d, expose_biz_his FROM texts"),
        "expose_history_label": _sql(_SHOWN, _queues(), _LAST_QUEUE, _queue_texts(), select="SELECT row_key, expose_biz_his FROM texts"),
        "expose_least_label": _sql(_SHOWN, _queues(), _LAST_QUEUE, _queue_texts(), select="SELECT row_key, expose_least_biz_7d FROM texts"),
        "expose_labels_short_gap": _sql(_SHOWN, _queues(172800000), _LAST_QUEUE, _queue_texts(6),
                                        select="SELECT row_key, expose_biz_his, expose_least_biz_7d FROM texts"),
        "stream_number_counts": _sql(_CARDS, _NUMBERS, select="""SELECT md5(uid) AS row_key, label, count(*) AS n
  FROM (SELECT * FROM cards UNION ALL SELECT * FROM numbers) GROUP BY uid, label"""),
        "stream_last_biz": _sql(_actions(_BIZ), _last("actions", "last_action"),
                                select=f"SELECT md5(uid) AS row_key, {_LAST_TEXT} AS user_last_biz FROM last_action"),
        "stream_daily_counts": _sql(scored, select="SELECT uid, day, channel, biz, count(*) AS n FROM actions GROUP BY ALL"),
        # Late is what is not above the newest time of the parts that arrived before, less 3 seconds.
        "stream_watermark": _sql("""
arrivals AS (SELECT event_id, ts_ms, ts_ms + CASE WHEN event_id % 5 = 0 THEN 172800000 ELSE 0 END AS arrival FROM ev)""", """
parts AS (SELECT event_id, ts_ms, (arrival - (SELECT min(arrival) FROM arrivals)) * 4
                 // ((SELECT max(arrival) FROM arrivals) - (SELECT min(arrival) FROM arrivals) + 1) AS part FROM arrivals)""", """
marks AS (SELECT part, max(max(ts_ms)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3000 AS mark
          FROM parts GROUP BY part)""", select="""
SELECT event_id, ts_ms AS event_ms, CASE WHEN ts_ms <= mark THEN 1 ELSE 0 END AS late FROM parts JOIN marks USING (part)"""),
        "stream_daily_counts_late": _sql(scored, select="SELECT uid, day, channel, biz, count(*) AS n FROM actions GROUP BY ALL"),
        "stream_biz_score": _sql(*_all_labels(), select="""SELECT * FROM label_rows
  WHERE label IN ('biz_score', 'biz_click', 'biz_search')"""),
        "stream_exposure": _sql(_SHOWN, _queues(), _LAST_QUEUE, _queue_texts(),
                                select="SELECT row_key, expose_least_biz_7d, expose_biz_his FROM texts"),
        "stream_biz_score_late": _sql(*_all_labels(), select="""SELECT * FROM label_rows
  WHERE label IN ('biz_score', 'biz_click', 'biz_search')"""),
        "stream_exposure_late": _sql(_SHOWN, _queues(), _LAST_QUEUE, _queue_texts(),
                                     select="SELECT row_key, expose_least_biz_7d, expose_biz_his FROM texts"),
        "label_table_long": _sql(*_all_labels(), select="SELECT * FROM label_rows"),
        "labels_as_of": _sql(*_all_labels(), select="""SELECT * FROM label_rows
  WHERE expire_ts = -1 OR expire_ts > (SELECT max(ts_ms) FROM ev)"""),
        "label_table_wide": _sql(*_all_labels(), select="SELECT row_key, " + ", ".join(
            f"max(value) FILTER (label = '{n}') AS \"{n}\"" for n in KNOWN_LABELS) + f""", '{{' || coalesce(string_agg('"' || label || '":"' || value || '"', ',' ORDER BY label)
  FILTER (label NOT IN ({', '.join(f"'{n}'" for n in KNOWN_LABELS)})), '') || '}}' AS other_labels FROM label_rows GROUP BY row_key"""),
    }
