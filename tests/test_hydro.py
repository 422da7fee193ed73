import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import hydrology as hy
from tidemark.operators import mergeable as mg
from tidemark.operators.screening import screen_series
from tidemark.plans import hydro

DAILY = "jaam_kood bigint, series string, date date, value double, n_hours int"


def days(first, last):
    d = first
    while d <= last:
        yield d
        d += dt.timedelta(days=1)


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for st in (1, 2, 3, 4, 5, 6):
        for d in days(dt.date(2018, 1, 1), dt.date(2021, 12, 31)):
            q = 10 + 4 * math.sin(d.timetuple().tm_yday / 365 * 2 * math.pi) + st + (2 if d.year == 2020 else 0)
            rows.append((st, "Äravool avg", d, q, 24))
            rows.append((st, "Äravool max", d, q + 1, 24))
            rows.append((st, "WT avg", d, 8.0 + (8 if 6 <= d.month <= 8 else 0), 24))
    rows += [(1, "Äravool avg", dt.date(2022, 1, 1), -1.0, 24), (1, "Äravool avg", dt.date(2022, 1, 2), 400.0, 24), (1, "WT avg", dt.date(2022, 1, 1), 40.0, 24), (1, "Äravool avg", dt.date(2022, 1, 3), 10.0, 10)]
    return spark.createDataFrame(rows, DAILY).cache()


def test_hourly_to_daily(spark):
    hours = [(1, s, f"2020-01-01T{h:02d}:00:00", float(h % 3 + 1)) for s in ("Äravool avg", "Äravool max", "Äravool min") for h in range(24)]
    hours += [(1, "Äravool avg", "2020-01-02T00:00:00", None), (1, "Äravool avg", "2020-01-02T01:00:00", 6.0)]
    df = spark.createDataFrame(hours, "jaam_kood bigint, series string, timeline_ts_utc string, vaartus double")
    got = {(r["series"], str(r["date"])): (r["value"], r["n_hours"]) for r in mg.daily(df).collect()}
    assert got[("Äravool avg", "2020-01-01")] == (2.0, 24)
    assert got[("Äravool max", "2020-01-01")][0] == 3.0 and got[("Äravool min", "2020-01-01")][0] == 1.0
    assert got[("Äravool avg", "2020-01-02")] == (6.0, 1)
    with pytest.raises(Exception, match="cannot aggregate"):
        mg.daily(df.withColumn("series", F.lit("Äravool sum"))).collect()


def test_screening_counts_what_it_drops(daily):
    kept, report = screen_series(daily, ["jaam_kood", "series"], "value", F.col("series").startswith("Äravool"))
    got = {(r["jaam_kood"], r["series"]): (r["negative"], r["spike"], r["out_of_range"]) for r in report.collect()}
    assert got == {(1, "Äravool avg"): (1, 1, 0), (1, "WT avg"): (0, 0, 1)}
    assert daily.count() - kept.count() == 3


def test_runoff_of_constant_flow(spark):
    rows = [(1, "Äravool avg", d, 10.0, 24) for d in days(dt.date(2019, 1, 1), dt.date(2019, 12, 31))]
    q = hy.valid_days(spark.createDataFrame(rows, DAILY), "Äravool avg")
    area = spark.createDataFrame([(1, 1000.0)], "jaam_kood bigint, area double")
    r = hy.annual_runoff(q, area).first()
    assert r["specific_ls_km2"] == pytest.approx(10.0) and r["runoff_mm"] == pytest.approx(315.576)
    assert hy.annual_runoff(q.limit(300), area).count() == 0


def test_exceedance_curve_falls(daily, spark):
    area = spark.createDataFrame([(s, 100.0 if s != 3 else 0.0) for s in range(1, 7)], "jaam_kood bigint, area double")
    q = hy.valid_days(daily, "Äravool max")
    curve = hy.flow_duration(q, area).where("jaam_kood = 2").orderBy("p").collect()
    assert [r["p"] for r in curve] == [float(p) for p in hy.EXCEEDANCE]
    values = [r["value"] for r in curve]
    assert values == sorted(values, reverse=True)
    assert hy.flow_duration(q, area).where("jaam_kood = 3").count() == 0


def test_rolling_minimum_needs_full_width(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([9, 1, 1, 1, 1, 1, 1, 1, 9])] + [("b", 1, 1.0)], "k string, d int, v double")
    assert [(r["k"], r["q7min"]) for r in hy.rolling_minimum(df, ["k"], "d", "v").collect()] == [("a", 1.0)]


def test_own_mean_percent(spark):
    df = spark.createDataFrame([(s, y, v * s) for s in range(1, 7) for y, v in ((2000, 0.5), (2001, 1.5))], "jaam_kood bigint, year int, runoff_mm double")
    got = {r["year"]: r["pct_of_mean"] for r in hy.percent_of_own_mean(df, "jaam_kood").collect()}
    assert got == {2000: pytest.approx(50.0), 2001: pytest.approx(150.0)}


def test_build(daily, spark):
    area = spark.createDataFrame([(s, 100.0) for s in range(1, 7)], "jaam_kood bigint, area double")
    rain = spark.createDataFrame([(y, 100.0 + y % 4) for y in range(2018, 2022)], "year int, precipitation double")
    out = hydro.build(daily, area, rain)
    nat = {r["year"]: r["pct_of_mean"] for r in out["national_runoff"].collect()}
    assert nat[2020] > nat[2019] and len(nat) == 4
    reg = out["regime"].where("jaam_kood = 2 and month = 7").first()
    assert reg["n_years"] == 3 and reg["current"] is not None and reg["q10"] <= reg["median"] <= reg["q90"]
    t = out["water_temperature"].where("jaam_kood = 2").first()
    assert t["summer_mean"] == pytest.approx(16.0) and t["n_summer"] == 92
    assert out["extremes"].where("jaam_kood = 2").count() == 4
    assert out["climate_link"].count() == 0  # four common years only
    assert out["summer_anomaly"].count() == 0 and out["dropped"].count() == 2
