from labelloom import dims
from labelloom.plans import labels
from labelloom.schemas import LABELS

T0 = 1_700_000_000_000
CLICK_DDL = "uid string, biz_type string, pb_name string, num_type string, ts_ms bigint, event_id bigint"
SEARCH_DDL = "search_mob string, biz_type string, number_type string, ts_ms bigint, event_id bigint"


def test_number_labels_count_every_event(spark):
    clicks = spark.createDataFrame(
        [("u", "cardModel", "点击号码", "03", T0 + i, i) for i in range(3)]
        + [("u", "cardModel", "点击叉号", "77", T0, 9), ("v", "cardModel", "点击号码", "03", T0, 10)],
        CLICK_DDL,
    )
    searches = spark.createDataFrame([("u", "number", "any type", T0 + 50, 11)], SEARCH_DDL)
    rows = labels.number_labels(clicks, searches).collect()
    assert sorted((r["label"], r["value"], r["write_ts"], r["expire_ts"]) for r in rows) == [
        ("any type_searchs", "1", T0 + 50, None),
        ("lucky_clicks", "1", T0, None),
        ("lucky_clicks", "3", T0 + 2, None),
        ("null_x", "1", T0, None),
    ]


def test_last_biz_takes_the_newest_of_both_channels(spark):
    clicks = spark.createDataFrame([("u", "xiaomiModel", None, None, T0, 1), ("v", "what", None, None, T0, 2)], CLICK_DDL)
    searches = spark.createDataFrame([("u", "what", None, T0, 3)], SEARCH_DDL)
    rows = {r["value"]: r["expire_ts"] - r["write_ts"] for r in labels.last_biz_labels(clicks, searches, "UTC").collect()}
    # Equal times: the higher event id is the later one. Search names are used as they are.
    assert rows == {"search,app,what,20231114221320": 120_000, "click,code,null,20231114221320": 120_000}


def test_visible(spark):
    rows = spark.createDataFrame([("k", "user_last_biz", "v", T0, T0 + 120_000), ("k", "lucky_x", "1", T0, None)], LABELS)
    assert {r["label"] for r in labels.visible(rows, T0 + 119_999).collect()} == {"user_last_biz", "lucky_x"}
    assert {r["label"] for r in labels.visible(rows, T0 + 120_000).collect()} == {"lucky_x"}


def test_wide(spark):
    rows = spark.createDataFrame(
        [("k", "lucky_x", "1", T0, None), ("k", "biz_click", "0,0,0,0,1", T0, T0), ("l", "lucky_x", "2", T0, None)], LABELS
    )
    got = {r["row_key"]: r.asDict() for r in labels.wide(rows).collect()}
    assert got["k"]["lucky_x"] == "1" and got["k"]["biz_click"] == "0,0,0,0,1" and got["l"]["lucky_x"] == "2"
    assert got["l"]["biz_click"] is None
    assert labels.wide(rows).columns == ["row_key", *dims.KNOWN_LABELS, "other_labels"]
    unknown = rows.union(spark.createDataFrame([("k", "vip_searchs", "3", T0, None)], LABELS))
    assert {r["row_key"]: r["other_labels"] for r in labels.wide(unknown).collect()} == {"k": {"vip_searchs": "3"}, "l": {}}
    assert labels.wide(rows, rest=None).columns == ["row_key", *dims.KNOWN_LABELS]
    assert len(dims.KNOWN_LABELS) == len(set(dims.KNOWN_LABELS)) == 9 * 3 + 6


def test_wide_with_unknown_labels(spark):
    rows = spark.createDataFrame(
        [("k", "lucky_x", "1", T0, None), ("k", "it's a `type`_searchs", "2", T0, None), ("l", "lucky_x", "3", T0, None)],
        LABELS,
    )
    got = {r["row_key"]: r.asDict() for r in labels.wide(rows, ["lucky_x"], rest="others").collect()}
    assert got["k"] == {"row_key": "k", "lucky_x": "1", "others": {"it's a `type`_searchs": "2"}}
    assert got["l"]["others"] == {}
    named = labels.wide(rows, ["it's a `type`_searchs"]).where("row_key = 'k'").first()
    assert named[1] == "2"
