import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import ranges

DDL = "uid string, ts_ms bigint, event_id bigint"


def sizes(df):
    """Rows of every partition."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_a_busy_second_of_one_user_is_spread_over_all_tasks(spark):
    """Nine rows of ten are one user's, within one second."""
    rows = spark.range(200_000).selectExpr(
        "if(id % 10 < 9, 'hot', concat('u', id % 997)) AS uid", "if(id % 10 < 9, 5000, 0) + id % 1000 AS ts_ms", "id AS event_id"
    )
    parts = 40
    loads = sizes(ranges.dealt(ranges.sliced(rows, ["uid", "ts_ms", "event_id"], parts), parts))
    assert len(loads) == parts and sum(loads) == 200_000
    assert loads[-1] <= 3 * loads[len(loads) // 2] and loads[-1] <= 2 * 200_000 // parts


@pytest.mark.parametrize("n, parts", [(0, 4), (1, 4), (5, 8), (400, 1), (400, 7), (400, 64)])
def test_slices_follow_the_order(spark, n, parts):
    rng = random.Random(n + parts)
    rows = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.randrange(9), i) for i in range(n)]
    cut = ranges.sliced(spark.createDataFrame(rows, DDL), ["uid", "ts_ms", "event_id"], parts).collect()
    assert len(cut) == n
    in_order = sorted(cut, key=lambda r: (r.uid is not None, r.uid or "", r.ts_ms, r.event_id))
    assert [r.slice for r in in_order] == sorted(r.slice for r in cut) and all(0 <= r.slice < parts for r in cut)
    for i, r in enumerate(in_order):
        # A mark may be set for nothing, at a bound between two users, but is never missing.
        assert r.opens or not any(o.uid == r.uid and o.slice < r.slice for o in in_order)
        assert r.goes_on or not any(o.uid == r.uid and o.slice > r.slice for o in in_order)
    groups = {}
    for r in in_order:
        groups.setdefault(r.slice, set()).add(r.uid) if r.opens else None
    assert all(len(g) == 1 for g in groups.values())


@pytest.mark.parametrize("parts", [1, 5, 50])
def test_places_within_a_group(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), rng.randrange(40), i) for i in range(500)] + [("hot", 7, 7)] * 20
    got = ranges.numbered(spark.createDataFrame(rows, DDL), "uid", ["ts_ms", "event_id"], parts).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.uid, []).append((r.place, r.ts_ms, r.event_id))
    assert len(got) == len(rows)
    for uid, placed in by_group.items():
        placed.sort()
        assert [p[0] for p in placed] == list(range(len(placed)))
        assert [p[1:] for p in placed] == sorted(r[1:] for r in rows if r[0] == uid)


def test_the_sample_does_not_depend_on_the_partitioning(spark):
    rows = spark.range(5_000).selectExpr("string(id % 7) AS uid", "id * 7919 % 1000 AS ts_ms", "id AS event_id")
    order = ["uid", "ts_ms", "event_id"]
    assert ranges.bounds(rows.repartition(1), order, 9).first() == ranges.bounds(rows.repartition(13), order, 9).first()
