"""Climate sections: normals, anomalies, national series with trends, seasons, indices and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import climatology as cl
from tidemark.operators import resample as rs

#: Element codes and report periods.
TEMPERATURE, PRECIPITATION = "DTA08", "DPREC"
PERIODS = ((1991, 2000), (2001, 2010), (2011, 2020), (2021, 2025))
CORE_YEARS, RECENT_FROM, STATION_REPS = 34, 2006, 300


def variant_series(
    df: DataFrame, entity: str, year: str, value: str, core_years: int = CORE_YEARS, recent_from: int = RECENT_FROM
) -> DataFrame:
    """National mean per year under three readings: all entities, nearly complete ones, recent years only."""
    rows = df.where(F.col(value).isNotNull())
    core = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("__k")).select(entity, (F.col("__k") >= core_years).alias("__core"))
    tags = F.filter(
        F.array(F.lit("all"), F.when(F.col("__core"), F.lit("core")), F.when(F.col(year) >= recent_from, F.lit("recent"))),
        lambda t: t.isNotNull(),
    )
    tagged = rows.join(core, entity).withColumn("variant", F.explode(tags))
    return tagged.groupBy("variant", year).agg(F.avg(value).alias("value"))


def annual_and_seasonal(
    df: DataFrame,
    kind: str,
    names: cl.Names = cl.Names(),
    base: tuple[int, int] = cl.BASELINE,
    min_years: int = cl.MIN_NORMAL_YEARS,
) -> DataFrame:
    """Complete years and seasons of every station in one long table ``(period, entity, year, anom)``."""
    normals = cl.monthly_normals(df, names, base, min_years)
    seasonal = cl.with_season(df, names)
    by = ["season", "season_year"]
    if kind == "ratio":
        year = cl.period_ratio(df, normals, [names.year], 12, names)
        part = cl.period_ratio(seasonal, normals, by, 3, names)
    else:
        year = cl.complete_periods(cl.anomalies(df, normals, "diff", names), [names.year], 12, names)
        part = cl.complete_periods(cl.anomalies(seasonal, normals, "diff", names), by, 3, names)
    keys = names.keys
    annual = year.select(F.lit("annual").alias("period"), *keys, F.col(names.year).alias("year"), "anom")
    return annual.unionByName(part.select(F.col("season").alias("period"), *keys, F.col("season_year").alias("year"), "anom"))


def analyse_variable(
    df: DataFrame, kind: str, names: cl.Names = cl.Names(), reps: int = rs.REPS, min_stations: int = cl.MIN_STATIONS
) -> dict[str, DataFrame]:
    """National annual and seasonal series with trends, station trends, robustness and the month grid."""
    by = ["period", *names.by]
    per_station = annual_and_seasonal(df, kind, names)
    national = rs.national_series(per_station, names.entity, "year", "anom", by, min_stations, reps)
    annual = per_station.where(F.col("period") == "annual")
    national_annual = national.where(F.col("period") == "annual")
    variants = variant_series(annual, names.entity, "year", "anom")
    out = {
        "national": national,
        "trends": rs.trend(national, by, "year", "mean", reps),
        "top_years": cl.top_periods(national_annual, "year", "mean", 5),
        "period_means": cl.period_means(national_annual, "year", "mean", PERIODS),
        "station_trends": rs.trend(annual, names.keys, "year", "anom", min(reps, STATION_REPS)),
        "robustness_block": _by_block(national_annual, reps),
        "robustness_variant": rs.trend(variants, ["variant"], "year", "value", reps),
        "normals": cl.monthly_normals(df, names),
    }
    if kind == "diff":
        out["month_grid"] = cl.month_grid(cl.anomalies(df, out["normals"], "diff", names), names, min_stations)
    return out


def _by_block(national: DataFrame, reps: int, blocks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    parts = [rs.trend(national, [], "year", "mean", reps, block=b).withColumn("block", F.lit(b)) for b in blocks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(
    monthly: DataFrame, indices: DataFrame, stations: DataFrame, reps: int = rs.REPS, index_columns: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """All climate sections; ``stations`` adds metadata to the stations that have data."""
    temp = monthly.where(F.col("element_kood") == TEMPERATURE)
    prec = monthly.where(F.col("element_kood") == PRECIPITATION)
    cols = [c for c in (index_columns or [*cl.DAY_INDICES, "Rx1day"]) if c in indices.columns]
    extremes = cl.index_series(indices, cols)
    out: dict[str, DataFrame] = {
        "stations": temp.groupBy("jaam_kood").agg(F.max("jaam_nimi").alias("jaam_nimi")).join(stations, "jaam_kood", "left"),
        "completeness": cl.completeness(temp),
        "extremes": extremes,
        "extreme_trends": rs.trend(extremes, ["index"], "aasta", "mean", reps),
    }
    sections: Mapping[str, tuple[DataFrame, str]] = {"temperature": (temp, "diff"), "precipitation": (prec, "ratio")}
    for name, (df, kind) in sections.items():
        for key, frame in analyse_variable(df, kind, reps=reps).items():
            out[f"{name}.{key}"] = frame
    return out
