import hashlib
import random

import pytest
from model import DAY, FIVE, HOUR, two_day_counts

from labelloom.operators import interest
from labelloom.plans import labels

T0 = 1_700_000_000_000
ACTION_DDL = "uid string, channel string, biz string, ts_ms bigint, event_id bigint"


def random_actions(seed, n=600, hot_share=0.0, days=5, step=HOUR // 4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        uid = "hot" if rng.random() < hot_share else f"u{rng.randrange(6)}"
        biz = rng.choice([*FIVE, "other", None])
        # Coarse times: ties are common and the event id has to break them.
        rows.append((uid, rng.choice(["click", "search"]), biz, T0 + rng.randrange(days * DAY // step) * step, i))
    return rows


def trace_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, ACTION_DDL)
    return {r["event_id"]: r.asDict() for r in interest.counts_trace(df, **kw).collect()}


def assert_trace(got, rows):
    want = two_day_counts(rows)
    assert got.keys() == want.keys()
    for eid, counts in want.items():
        assert {(c, b): got[eid][f"{c}_{b}"] for c, b in counts} == counts, eid


@pytest.mark.parametrize("seed", range(4))
def test_counts_trace_against_the_model(spark, seed):
    rows = random_actions(seed, days=4 + 3 * seed)
    assert_trace(trace_of(spark, rows), rows)


@pytest.mark.parametrize("seed, parts, days", [(11, 2, 5), (12, 7, 5), (13, 40, 9), (14, 90, 2)])
def test_slices_do_not_show(spark, seed, parts, days):
    rows = random_actions(seed, hot_share=0.5, days=days)
    assert_trace(trace_of(spark, rows, parts=parts), rows)


@pytest.mark.parametrize("parts", [3, 40])
def test_days_across_many_slices(spark, parts):
    """One user, three days of which one is nearly empty and one holds nearly everything within a second."""
    rng = random.Random(parts)
    times = [T0 - DAY + rng.randrange(DAY // 2) for _ in range(20)] + [T0] * 300 + [T0 + DAY + i for i in range(60)] + [T0 + 2 * DAY] * 9
    rows = [("u", rng.choice(["click", "search"]), rng.choice(FIVE), t, i) for i, t in enumerate(times)]
    rows += [("v", "click", "family", T0 + DAY, 1_000), ("a", "click", "family", T0, 1_001)]
    assert_trace(trace_of(spark, rows, parts=parts), rows)


def test_a_trace_of_nothing(spark):
    assert interest.counts_trace(spark.createDataFrame([], ACTION_DDL)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_latest_counts_are_the_last_of_the_trace(spark, seed):
    rows = random_actions(seed + 20, n=200, days=12)
    want, model = {}, two_day_counts(rows)
    for uid, channel, _, ts, eid in sorted(rows, key=lambda r: (r[3], r[4])):
        of_user = want.setdefault(uid, {})
        of_user["last"] = model[eid]
        of_user[channel] = (ts, [model[eid][channel, b] for b in FIVE])
    got = interest.latest_counts(spark.createDataFrame(rows, ACTION_DDL)).collect()
    assert {r["uid"] for r in got} == want.keys()
    for r in got:
        w = want[r["uid"]]
        assert {(c, b): r["at_last"][f"{c}_{b}"] for c, b in w["last"]} == w["last"]
        for channel in ("click", "search"):
            own = r[f"at_{channel}"]
            if channel in w:
                assert (r[f"last_{channel}_ts"], list(own)) == w[channel]
            else:
                assert own is None and r[f"last_{channel}_ts"] is None


def test_old_days_are_forgotten(spark):
    rows = [("u", "click", "family", T0 + d * DAY, d) for d in (0, 1, 2, 5)]
    got = trace_of(spark, rows)
    assert [got[d]["click_family"] for d in (0, 1, 2, 5)] == [1, 2, 2, 1]


def test_the_day_turns_at_utc_plus_8(spark):
    midnight = 19676 * DAY - 8 * HOUR
    rows = [("u", "click", "family", t, i) for i, t in enumerate([midnight - 1, midnight, midnight + 2 * DAY])]
    counts = {r["event_id"]: r["click_family"] for r in trace_of(spark, rows).values()}
    assert counts == {0: 1, 1: 2, 2: 1}
    days = interest.daily_counts(spark.createDataFrame(rows, ACTION_DDL)).collect()
    assert sorted(r["day"] for r in days) == [19675, 19676, 19678]


def test_weights_reach_their_own_counts(spark):
    rows = [("u", "click", "family", T0, 0), ("u", "search", "family", T0 + 1, 1), ("u", "search", "package", T0 + 2, 2)]
    df = interest.counts_trace(spark.createDataFrame(rows, ACTION_DDL))
    w = {"click_weight": dict.fromkeys(FIVE, 3), "search_weight": dict.fromkeys(FIVE, 10), "biz_weight": dict.fromkeys(FIVE, 2)}
    last = interest.with_raw_scores(df, **w).where("event_id = 2").first()
    assert [last[c] for c in interest.RAW_SCORES] == [0, 0, 20, 0, 26]


def test_score_labels_of_one_user(spark):
    clicks = spark.createDataFrame(
        [("u1", "familyModel", None, None, T0, 0), ("u1", "xiaomiModel", None, None, T0 + 1, 1)],
        "uid string, biz_type string, pb_name string, num_type string, ts_ms bigint, event_id bigint",
    )
    searches = spark.createDataFrame(
        [("u1", "number", None, T0 + 5, 2), ("u2", "elsewhere", None, T0, 3)],
        "search_mob string, biz_type string, number_type string, ts_ms bigint, event_id bigint",
    )
    got = {(r["row_key"], r["label"]): (r["value"], r["write_ts"], r["expire_ts"]) for r in
           labels.score_labels(clicks, searches).collect()}
    u1, u2 = (hashlib.md5(u).hexdigest() for u in (b"u1", b"u2"))
    ttl = 2 * DAY
    assert got == {
        (u1, "biz_score"): ("0.05435,0.05435,0.05435,0.41848,0.41848", T0 + 5, T0 + 5 + ttl),
        (u1, "biz_click"): ("0,0,0,0,1", T0 + 1, T0 + 1 + ttl),
        (u1, "biz_search"): ("0,0,0,1,0", T0 + 5, T0 + 5 + ttl),
        (u2, "biz_score"): ("NaN,NaN,NaN,NaN,NaN", T0, T0 + ttl),
        (u2, "biz_search"): ("0,0,0,0,0", T0, T0 + ttl),
    }
