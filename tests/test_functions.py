import collections
import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.functions.quantiles import LINEAR, NEAREST, array_median, bounded_nearest, column_quantiles, group_quantiles
from tidemark.functions.ranks import earliest, hash_positions, latest, value_positions
from tidemark.operators import resample as rs
from tidemark.operators.resample import spearman


def linear(xs, q):
    xs = sorted(xs)
    pos = q * (len(xs) - 1)
    lo = int(pos)
    hi = min(lo + 1, len(xs) - 1)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


def nearest(xs, q):
    xs = sorted(xs)
    return xs[int(q * (len(xs) - 1) + 0.5)]


@pytest.mark.parametrize("size", [4096, 1])
def test_group_quantiles_exact_with_hot_group_and_ties(spark, monkeypatch, size):
    monkeypatch.setattr("tidemark.functions.quantiles.RANGES", size)
    rnd = random.Random(1)
    data = [("hot", float(rnd.randint(0, 400))) for _ in range(3000)] + [("hot", 7.0)] * 1500
    data += [("small", float(i)) for i in (5, 1, 3)] + [(None, 2.0), (None, 4.0), ("one", 9.5)]
    df = spark.createDataFrame(data, "k string, v double")
    probs = {"a": (0.1, LINEAR), "m": (0.5, LINEAR), "n": (0.95, NEAREST), "lo": (0.0, NEAREST), "hi": (1.0, LINEAR)}
    got = {r["k"]: r for r in group_quantiles(df, ["k"], "v", probs).collect()}
    for key in {k for k, _ in data}:
        xs = [v for k, v in data if k == key]
        assert got[key]["a"] == pytest.approx(linear(xs, 0.1))
        assert got[key]["m"] == pytest.approx(statistics.median(xs))
        assert got[key]["n"] == nearest(xs, 0.95)
        assert got[key]["lo"] == min(xs) and got[key]["hi"] == max(xs)


def test_quantiles_of_groups_of_unlike_range(spark):
    rnd = random.Random(2)
    groups = {"tiny": [rnd.uniform(-1e-300, 1e-300) for _ in range(700)], "wide": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-200, 200) for _ in range(700)], "near": [1.7e9 + rnd.random() / 100 for _ in range(700)], "odd": [0.0, -0.0, float("inf"), float("-inf"), 5e-324, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(4)
    probs = {f"p{i}": (i / 10, NEAREST) for i in range(11)} | {"m": (0.5, LINEAR)}
    for r in group_quantiles(df, ["k"], "v", probs).collect():
        assert [r[f"p{i}"] for i in range(11)] == [nearest(groups[r["k"]], i / 10) for i in range(11)]
        assert r["m"] == pytest.approx(linear(groups[r["k"]], 0.5), rel=1e-12)


def test_quantiles_of_whole_table_and_several_columns(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(11)] + [(None, None)], "a double, b double")
    r = group_quantiles(df, [], "a", {"q": (0.25, LINEAR)}).first()
    assert r["q"] == 2.5
    r = column_quantiles(df, [], {"x": ("a", 0.5, LINEAR), "y": ("b", 0.1, NEAREST)}).first()
    assert (r["x"], r["y"]) == (5.0, -9.0)


def test_bounded_quantiles_and_array_median(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "v double")
    assert df.agg(bounded_nearest("v", 0.9).alias("q")).first()["q"] == 5.0
    one = spark.range(1)
    assert one.select(array_median(F.array(F.lit(4.0), F.lit(1.0), F.lit(3.0), F.lit(2.0))).alias("m")).first()["m"] == 2.5
    assert one.select(array_median(F.array().cast("array<double>")).alias("m")).first()["m"] is None


def test_hash_positions_are_dense_and_independent_of_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("e"), (F.col("id") % 2).alias("g"))
    a = {r["e"]: r["pos"] for r in hash_positions(df.repartition(7), "e").collect()}
    b = {r["e"]: r["pos"] for r in hash_positions(df.repartition(2), "e").collect()}
    assert a == b and sorted(a.values()) == list(range(500))
    per = hash_positions(df, "e", ["g"]).groupBy("g").agg(F.max("pos").alias("m"), F.max("n").alias("n")).collect()
    assert {(r["m"], r["n"]) for r in per} == {(249, 250)}


def test_latest_treats_missing_order_as_oldest(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", "2020", "y"), ("b", None, "z")], "k string, t string, v string")
    assert {r["k"]: r["v"] for r in latest(df, ["k"], ["t"], ["v"]).collect()} == {"a": "y", "b": "z"}
    assert {r["k"]: r["v"] for r in earliest(df, ["k"], ["t"], ["v"]).collect()} == {"a": "x", "b": "z"}


def test_text_rules(spark):
    df = spark.createDataFrame(
        [(">20-25%",), ("0 %, ei ole",), ("100 %, surnud",), ("Hindamata",), (">55–60%",), (None,), ("mitu",)], "t string"
    )
    got = [r["u"] for r in df.select(c.upper_bound("t").alias("u")).collect()]
    assert got == [25.0, 0.0, 100.0, None, 60.0, None, None]
    d = spark.createDataFrame([("vana 12.03.1998 kpv",), ("2015. a",), ("-",)], "t string")
    assert [r["y"] for r in d.select(c.registration_year("t").alias("y")).collect()] == [1998, 2015, None]
    assert [r["y"] for r in d.select(c.version_label("t").alias("y")).collect()] == ["1998", "2015", "?"]


def test_seasons_periods_bins(spark):
    df = spark.createDataFrame([(2020, 12), (2021, 1), (2021, 6)], "y int, m int")
    got = df.select(c.season("m"), c.season_year("y", "m")).collect()
    assert [tuple(r) for r in got] == [("DJF", 2021), ("DJF", 2021), ("JJA", 2021)]
    y = spark.createDataFrame([(2002,), (2006,), (2007,), (2024,)], "y int")
    assert [r[0] for r in y.select(c.period_label("y")).collect()] == ["2002-2006", "2002-2006", "2007-2011", "2022-2026"]
    v = spark.createDataFrame([(10.0,), (25.1,), (None,)], "v double")
    edges = [(10.0, "none"), (25.0, "slight"), (60.0, "moderate")]
    assert [r[0] for r in v.select(c.bin_of("v", edges, "severe")).collect()] == ["none", "moderate", None]


def test_null_rules(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", None, 2.0), (None, float("nan"), 4.0)], "k string, v double, w double")
    r = df.agg(c.distinct_with_null("k").alias("n"), c.sum_where("v", F.col("k") == "zz").alias("s")).first()
    assert (r["n"], r["s"]) == (2, 0.0)
    assert [x[0] for x in df.select(c.ratio("w", "v")).collect()][:2] == [0.0, None]
    assert [x[0] for x in df.select(c.clean_round("v")).collect()] == [1.0, None, None]
    joined = c.join_same(df, df.select("k", F.lit(5).alias("z")).distinct(), ["k"])
    assert joined.count() == 3


def test_value_positions_part_ties_and_place_nulls_first(spark):
    rows = [(None if i % 50 == 0 else i % 3, (i * 7919) % 4_001) for i in range(4_001)]
    df = spark.createDataFrame(rows, "v int, t int")
    got = {(r["v"], r["t"]): r["pos"] for r in value_positions(df, ["v", "t"]).collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {r: i for i, r in enumerate(want)}
    assert value_positions(df.where("t < 0"), ["v", "t"]).count() == 0


def test_rank_correlation_of_a_million_pairs_has_no_single_task(spark):
    df = spark.range(1_000_000).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"), (F.pmod(F.xxhash64("id"), F.lit(1000)) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("y"))
    out = spearman(df, [], "id", "x", "y", reps=0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" in plan and all("[__part" in line for line in plan.splitlines() if "row_number()" in line)
    p = df.toPandas().sort_values("id")
    want = p["x"].rank(method="first").corr(p["y"].rank(method="first"))
    got = out.first()
    assert got["n"] == 1_000_000 and abs(got["rho"] - want) < 1e-9


def test_draws_of_a_bootstrap_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(rs, "TASK_DRAWS", 1_000)
    entities = [None, *range(1, 200)]
    rows = spark.createDataFrame([(e, y) for e in entities for y in (1, 2)], "e long, y int")
    found = rs.entity_weights(rows, [], "e", 100, 3).withColumn("task", F.spark_partition_id()).collect()
    # 20 000 draws: no task holds more than a few thousand of them
    held = collections.Counter()
    for r in found:
        held[r.task] += r.weight
    assert len(held) >= 15 and max(held.values()) <= 4_000
    # null has no md5 and comes first
    order = sorted(entities, key=lambda e: (e is not None, hashlib.md5(str(e).encode()).hexdigest()))
    drawn = collections.Counter((rep, order[int(hashlib.md5(f"3|{rep}|{p}".encode()).hexdigest()[:15], 16) % 200]) for rep in range(100) for p in range(200))
    want = {k: v for k, v in drawn.items() if k[1] is not None}
    assert {(r.rep, r.e): r.weight for r in found if r.e is not None} == want
