"""Hydrology sections: screening, regimes, runoff, exceedance, extremes, temperature and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import hydrology as hy
from tidemark.operators.screening import screen_series
from tidemark.sources.staging import staged

#: Series names.
FLOW_PREFIX = "Äravool"
Q_AVG, Q_MAX, WT_AVG = "Äravool avg", "Äravool max", "WT avg"


def areas(catalogue: DataFrame) -> DataFrame:
    """Catchment area per station of a nested station catalogue."""
    s = catalogue.select(F.explode("stations").alias("s"))
    return s.select(F.col("s.jaam_kood").alias("jaam_kood"), F.col("s.valgala_suurus_km2").alias("area"))


def build(daily: DataFrame, area: DataFrame, climate: DataFrame | None = None, stations: DataFrame | None = None) -> dict[str, DataFrame]:
    """All sections; ``climate`` is a yearly series ``(year, precipitation)`` of another theme."""
    kept, dropped = screen_series(daily, ["jaam_kood", "series"], "value", F.col("series").startswith(FLOW_PREFIX))
    clean = staged(kept)  # read by every branch below
    q_avg, q_max, wt = (hy.valid_days(clean, s) for s in (Q_AVG, Q_MAX, WT_AVG))
    annual = hy.annual_runoff(q_avg, area)
    national = hy.percent_of_own_mean(annual, "jaam_kood")
    regime = hy.regime(hy.monthly_means(q_avg))
    temp = hy.water_temperature(wt)
    span = q_avg.groupBy("jaam_kood").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("valid_days"))
    out = {
        "stations": span if stations is None else span.join(stations, "jaam_kood", "left"),
        "regime": regime,
        "annual": annual,
        "national_runoff": national,
        "flow_duration": hy.flow_duration(q_avg, area),
        "extremes": hy.annual_extremes(q_avg, q_max),
        "water_temperature": temp,
        "coverage": hy.coverage(q_avg),
        "plausibility_runoff": hy.plausibility(annual, "specific_ls_km2"),
        "plausibility_temperature": hy.plausibility(wt, "value"),
        "dropped": dropped,
        "specific_regime": hy.specific_regime(regime, area),
        "summer_anomaly": hy.summer_anomaly(temp),
    }
    if climate is not None:
        aligned, corr = hy.link_series(climate, national, "year", "precipitation", "pct_of_mean")
        out["climate_link"], out["climate_rank_correlation"] = aligned, corr
    return out
