import random
from itertools import combinations, permutations

import pytest
from model import DAY, SIX, exposure_texts, queues

from labelloom.operators import exposure
from labelloom.plans import labels

T0 = 1_700_000_000_000
SHOWN_DDL = "uid string, biz string, ts_ms bigint, event_id bigint"


def shown(spark, rows):
    return spark.createDataFrame(rows, SHOWN_DDL)


def of_queues(spark, *qs):
    """One user per queue, entries one second apart."""
    return shown(spark, [(str(u), b, T0 + 1000 * i, i) for u, q in enumerate(qs) for i, b in enumerate(q)])


def batch_texts(spark, rows, pad_below=5, **kw):
    counts = exposure.latest_counts(rows, **kw)
    out = counts.selectExpr("uid", f"{exposure.least_text(pad_below)} AS least", f"{exposure.history_text(pad_below)} AS his")
    return {r["uid"]: (r["least"], r["his"]) for r in out.collect()}


def array_texts(spark, *qs, pad_below=5):
    df = spark.createDataFrame([(str(u), list(q)) for u, q in enumerate(qs)], "uid string, queue array<string>")
    counts = df.selectExpr("uid", *exposure.counts_of_array("queue"))
    out = counts.selectExpr("uid", f"{exposure.least_text(pad_below)} AS least", f"{exposure.history_text(pad_below)} AS his")
    return {r["uid"]: (r["least"], r["his"]) for r in out.collect()}


GOLDEN = [
    (["family"], "number,xiaomi", "number:0,xiaomi:0,package:0,broadband:0,terminal:0,family:1"),
    (["number"], "xiaomi,package", "number:1,xiaomi:0,package:0,broadband:0,terminal:0,family:0"),
    (["xiaomi"], "number,package", "xiaomi:1,number:0,package:0,broadband:0,terminal:0,family:0"),
    (["family", "terminal", "broadband", "package", "number", "xiaomi"], "xiaomi,number",
     "xiaomi:1,number:1,package:1,broadband:1,terminal:1,family:1"),
    (["family", "terminal", "broadband", "package", "number"], "number,package",
     "number:1,package:1,broadband:1,terminal:1,family:1"),
]


def test_golden_texts(spark):
    qs = [g[0] for g in GOLDEN]
    want = {str(i): g[1:] for i, g in enumerate(GOLDEN)}
    assert batch_texts(spark, of_queues(spark, *qs)) == want
    assert array_texts(spark, *qs) == want
    assert {str(i): exposure_texts(q) for i, q in enumerate(qs)} == want


def test_every_pair_and_order_of_businesses(spark):
    qs = [[a, b] for a, b in permutations(SIX, 2)] + [list(c) for c in combinations(SIX, 5)] + list(map(list, permutations(SIX)))[::37]
    want = {str(i): exposure_texts(q) for i, q in enumerate(qs)}
    assert batch_texts(spark, of_queues(spark, *qs)) == want
    assert array_texts(spark, *qs) == want


@pytest.mark.parametrize("pad_below", [5, 6])
def test_random_queues(spark, pad_below):
    rng = random.Random(5)
    qs = [[rng.choice(SIX[: rng.randint(1, 6)]) for _ in range(rng.randint(1, 12))] for _ in range(300)]
    want = {str(i): exposure_texts(q, pad_below) for i, q in enumerate(qs)}
    assert batch_texts(spark, of_queues(spark, *qs), pad_below) == want
    assert array_texts(spark, *qs, pad_below=pad_below) == want


def test_five_distinct_are_not_padded(spark):
    q = ["family", "terminal", "broadband", "package", "number"]
    assert batch_texts(spark, of_queues(spark, q))["0"][0] == "number,package"
    assert batch_texts(spark, of_queues(spark, q), pad_below=6)["0"][0] == "xiaomi,number"


def test_thirteenth_exposure_pushes_out_the_oldest(spark):
    rows = of_queues(spark, ["family"] + ["number"] * 12)
    last = exposure.queue_trace(rows).where("event_id = 12").first()
    assert last["queue"] == ["number"] * 12
    assert exposure.latest_counts(rows).first()["n_family"] == 0


@pytest.mark.parametrize("gap, kept", [(7 * DAY - 1, 2), (7 * DAY, 1), (30 * DAY, 1)])
def test_idle_reset(spark, gap, kept):
    rows = shown(spark, [("u", "family", T0, 0), ("u", "number", T0 + gap, 1)])
    trace = {r["event_id"]: r["queue"] for r in exposure.queue_trace(rows).collect()}
    assert len(trace[1]) == kept
    latest = exposure.latest_counts(rows).first()
    assert latest["n_family"] + latest["n_number"] == kept
    assert exposure.gap_groups(rows).first()["groups"] == 3 - kept


def random_shown(seed, n=500, hot_share=0.0, step=7_200_000, days=40):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < hot_share else f"u{rng.randrange(8)}", rng.choice(SIX),
         T0 + rng.randrange(days * DAY // step) * step, i)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, gap", [(1, DAY), (2, 2 * DAY), (3, DAY // 2), (4, 7 * DAY)])
def test_trace_latest_and_gap_groups_against_the_model(spark, seed, gap):
    rows = random_shown(seed)
    want, starts = queues(rows, gap)
    df = shown(spark, rows)
    assert {r["event_id"]: r["queue"] for r in exposure.queue_trace(df, gap_ms=gap).collect()} == want
    assert {r["uid"]: r["groups"] for r in exposure.gap_groups(df, gap_ms=gap).collect()} == starts
    newest = {}
    for uid, _, ts, eid in sorted(rows, key=lambda r: (r[2], r[3])):
        newest[uid] = exposure_texts(want[eid])
    assert batch_texts(spark, df, gap_ms=gap) == newest


@pytest.mark.parametrize("seed, parts, gap", [(21, 4, DAY), (22, 16, DAY // 4), (23, 60, 2 * DAY)])
def test_slices_do_not_show(spark, seed, parts, gap):
    rows = random_shown(seed, hot_share=0.5)
    got = exposure.queue_trace(shown(spark, rows), gap_ms=gap, parts=parts).collect()
    want, _ = queues(rows, gap)
    assert len(got) == len(rows)
    assert {r["event_id"]: r["queue"] for r in got} == want


@pytest.mark.parametrize("parts", [2, 9, 50])
def test_a_queue_longer_than_a_slice(spark, parts):
    """Slices shorter than a queue: the entries before one come from several others, across pauses."""
    rng = random.Random(parts)
    times, t = [], T0
    for _ in range(200):
        t += rng.choice([0, 0, 1, 1_000, DAY // 3, DAY])
        times.append(t)
    rows = [("u", rng.choice(SIX), t, i) for i, t in enumerate(times)] + [("t", "family", T0, 500), ("v", "number", T0, 501)]
    got = exposure.queue_trace(shown(spark, rows), gap_ms=DAY, parts=parts).collect()
    assert {r["event_id"]: r["queue"] for r in got} == queues(rows, DAY)[0] and len(got) == len(rows)
    assert exposure.queue_trace(shown(spark, [])).count() == 0


def test_exposure_labels(spark):
    rows = [("u1", "familyModel", "首页-专享", T0, 0), ("u1", "otherModel", "首页-专享", T0 + 9, 1)]
    log = spark.createDataFrame(rows, "uid string, biz_type string, storey string, ts_ms bigint, event_id bigint")
    got = {r["label"]: (r["value"], r["write_ts"], r["expire_ts"]) for r in labels.exposure_labels(log).collect()}
    assert got == {
        "expose_least_biz_7d": ("number,xiaomi", T0, T0 + 7 * DAY),
        "expose_biz_his": (GOLDEN[0][2], T0, T0 + 7 * DAY),
    }
