import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import climatology as cl
from tidemark.operators import resample as rs
from tidemark.plans import climate


@pytest.fixture(scope="module")
def monthly(spark):
    rnd = random.Random(5)
    data = []
    for s in range(8):
        for y in range(1991, 2026):
            for m in range(1, 13):
                v = 5 - 10 * math.cos(m / 12 * 2 * math.pi) + s + 0.05 * (y - 1991) + rnd.gauss(0, 0.6)
                data.append((f"S{s}", f"Station {s}", y, m, v, "DTA08"))
                data.append((f"S{s}", f"Station {s}", y, m, max(0.0, 50 + rnd.gauss(0, 10)), "DPREC"))
    return spark.createDataFrame(data, "jaam_kood string, jaam_nimi string, aasta int, kuu int, vaartus double, element_kood string").cache()


def test_baseline_anomalies_average_zero_and_trend_is_recovered(monthly):
    temp = monthly.where(F.col("element_kood") == "DTA08")
    normals = cl.monthly_normals(temp)
    anom = cl.anomalies(temp, normals)
    mean = anom.where(F.col("aasta") <= 2020).agg(F.avg("anom")).first()[0]
    assert abs(mean) < 1e-9
    annual = cl.complete_periods(anom, ["aasta"], 12)
    nat = rs.national_series(annual, "jaam_kood", "aasta", "anom", reps=60)
    for r in nat.collect():
        assert r["lo"] <= r["mean"] <= r["hi"] and r["p10"] <= r["p90"] and r["n"] == 8
    t = rs.trend(nat, [], "aasta", "mean", reps=60).first()
    assert abs(t["slope_per_decade"] - 0.5) < 0.15 and t["lo"] <= 0.5 <= t["hi"] and t["n"] == 35


def test_gates(spark, monthly):
    temp = monthly.where((F.col("element_kood") == "DTA08") & (F.col("aasta") >= 1997))
    assert cl.monthly_normals(temp).count() == 0  # 24 of 30 baseline years
    few = spark.createDataFrame([("a", 2000, 1.0), ("b", 2000, 3.0)], "e string, y int, v double")
    r = rs.national_series(few, "e", "y", "v", reps=0).first()
    assert r["mean"] is None and r["n"] == 2
    with pytest.raises(ValueError):
        cl.anomalies(temp, cl.monthly_normals(temp), "other")


def test_period_ratio_uses_totals_and_complete_years(spark):
    data = [("a", y, m, 10.0 * (2 if y == 2021 else 1)) for y in range(1991, 2023) for m in range(1, 13) if (y, m) != (2022, 12)]
    df = spark.createDataFrame(data, "jaam_kood string, aasta int, kuu int, vaartus double")
    out = {r["aasta"]: r["anom"] for r in cl.period_ratio(df, cl.monthly_normals(df), ["aasta"], 12).collect()}
    assert out[2021] == pytest.approx(200.0) and 2022 not in out


def test_day_indices_and_gate(spark):
    tmax = [-1.0] * 10 + [26.0] * 20 + [31.0] * 5 + [10.0] * 330
    tmin = [-2.0] * 50 + [21.0] * 3 + [5.0] * 312
    prec = [12.0, 25.0] + [0.0] * 363
    rows = [("a", 2000, "tmax", v) for v in tmax] + [("a", 2000, "tmin", v) for v in tmin] + [("a", 2000, "prec", v) for v in prec[:200]]
    df = spark.createDataFrame(rows, "jaam_kood string, aasta int, variable string, vaartus double")
    r = cl.day_indices(df).first()
    assert (r["ID"], r["SU25"], r["HD30"], r["FD"], r["TR20"]) == (10, 25, 5, 50, 3)
    assert r["R10"] is None and r["Rx1day"] is None  # 200 rain days only
    full = spark.createDataFrame([("a", 2000, "prec", v) for v in prec], df.schema)
    r = cl.day_indices(full).first()
    assert (r["R10"], r["R20"], r["Rx1day"], r["FD"]) == (2, 1, 25.0, None)


def test_index_series_and_top_periods(spark):
    idx = spark.createDataFrame([(f"s{i}", 2000, 10 * i) for i in range(6)] + [("s0", 2001, 1), ("s1", 2001, 2)], "jaam_kood string, aasta int, FD int")
    got = cl.index_series(idx, ["FD"]).collect()
    assert len(got) == 1 and got[0]["median"] == 25.0 and got[0]["q10"] == 10.0 and got[0]["n"] == 6
    s = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 9.0)], "y int, v double")
    assert [r["y"] for r in cl.top_periods(s, "y", "v", 2).collect()] == [3, 4]


def test_theil_sen_and_rank_correlation_edges(spark):
    df = spark.createDataFrame([("a", i, 2.0 * i) for i in range(6)] + [("b", 1, 1.0), ("b", 2, 5.0)], "k string, x int, y double")
    got = {r["k"]: r["slope"] for r in rs.theil_sen(df, ["k"], "x", "y").collect()}
    assert got == {"a": 2.0, "b": None}
    r = rs.spearman(df.where("k = 'a'"), [], "x", "x", "y", reps=50).first()
    assert r["rho"] == pytest.approx(1.0) and r["n"] == 6 and r["hi"] <= 1.0 + 1e-12
    short = rs.spearman(df.where("k = 'b'"), [], "x", "x", "y", reps=10).first()
    assert short["rho"] is None and short["n"] == 2
    again = rs.trend(spark.createDataFrame([(i, float(i % 4)) for i in range(12)], "x int, y double"), [], "x", "y", reps=30)
    assert again.collect() == again.repartition(3).collect()


def test_build_sections(spark, monthly):
    idx = spark.createDataFrame([(f"S{s}", y, s + y % 3) for s in range(8) for y in range(1991, 2010)], "jaam_kood string, aasta int, FD int")
    meta = spark.createDataFrame([("S1", 58.0)], "jaam_kood string, laiuskraad double")
    out = climate.build(monthly, idx, meta, reps=5)
    assert out["stations"].count() == 8
    assert out["temperature.national"].where(F.col("period") == "annual").count() == 35
    assert {r["variant"] for r in out["temperature.robustness_variant"].collect()} == {"all", "core", "recent"}
    assert out["precipitation.period_means"].where(F.col("from") == 2021).first()["n_years"] == 5
