"""As-of and range joins against loops, with hot keys, ties, open ends and nulls."""

import datetime
import random

import pytest

from tidemark.operators import ordered_joins as oj
from tidemark.plans.queries import load_all


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 40])
def test_as_of(spark, strict, tolerance):
    rng = random.Random(2)
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", None])
    left = [(k, key(), rng.choice([None, *range(0, 1000, 7)])) for k in range(600)] + [(600, "hot", 5), (600, "hot", 5)]
    right = [(key(), rng.choice([None, *range(0, 1000, 3)]), rng.randint(0, 9), "x") for _ in range(150)]
    frames = spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, s int, v int, w string")
    got = oj.as_of_join(*frames, ["k"], "t", "s", ["v", "w"], tolerance, strict, cells=16).collect()
    assert got and len(got) == len(left)
    for r in got:
        ok = [(s, v) for k, s, v, _ in right if None not in (k, s, r.t) and k == r.k and (s < r.t if strict else s <= r.t)]
        s, v = max(ok, default=(None, None))
        if s is not None and tolerance is not None and r.t - s > tolerance:
            s = v = None
        assert (r.s, r.v) == (s, v)
    empty = oj.as_of_join(frames[0], frames[1].where("v > 99"), ["k"], "t", "s", ["v"], tolerance, strict).collect()
    assert len(empty) == len(left) and all(r.v is None for r in empty)


def test_as_of_times_and_days(spark):
    day = datetime.datetime(2024, 1, 1)
    left = spark.createDataFrame([(day + datetime.timedelta(hours=h),) for h in (0, 1, 30)], "t timestamp")
    right = spark.createDataFrame([(day + datetime.timedelta(hours=1), 1)], "s timestamp, v int")
    assert [r.v for r in oj.as_of_join(left, right, [], "t", "s", ["v"], tolerance=3_600_000_000).orderBy("t").collect()] == [None, 1, None]


def test_range_join(spark):
    rng = random.Random(3)
    points = [(k, rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(-50, 400)])) for k in range(300)]
    spans = [(k, rng.choice(["hot", "a", None]), rng.choice([None, *range(-60, 300)]), rng.choice([None, 0, 1, 7, 64, 300, -3])) for k in range(80)]
    spans = [(k, key, lo, None if size is None else (lo or 0) + size) for k, key, lo, size in spans]
    joined = oj.range_join(spark.createDataFrame(points, "id int, k string, t int"), spark.createDataFrame(spans, "span int, k string, lo int, hi int"), ["k"], "t", "lo", "hi")
    want = sorted((p, s) for p, k, t in points for s, key, lo, hi in spans if None not in (k, t) and k == key and (lo is None or lo <= t) and (hi is None or t <= hi))
    assert sorted((r.id, r.span) for r in joined.collect()) == want and want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastExchange" not in plan


def test_orders_open_at_broadcasts_no_orders(spark, tmp_path):
    day = lambda k: datetime.datetime(2024, 1, k)
    orders = [(1, 7, "F", day(1)), (2, 7, "O", day(3)), (3, 7, "F", day(9)), (4, 8, "F", day(2)), (5, None, "F", day(2))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, day(4)), (1, day(2)), (3, day(9)), (9, day(1))], "l_orderkey long, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = load_all()["orders_open_at"].run(spark, str(tmp_path))
    # order 1 is open on days 1 to 4, order 2 from day 3 on, order 3 on day 9; order 4 has no lines and stays open
    assert {r.o_custkey: (r.pairs, r.still_open, r.orders) for r in found.collect()} == {7: (5, 2, 3), 8: (1, 1, 1)}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
