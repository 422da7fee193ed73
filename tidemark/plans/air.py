"""Ambient air quality: daily means, station years with a completeness rule, spread and paired change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import lookup, ratio, text_day, text_year
from tidemark.functions.quantiles import LINEAR, with_quantiles
from tidemark.operators.screening import target_unit_only
from tidemark.operators.transition import paired_ends
from tidemark.plans.monitoring import has_rows

#: Programme, group, indicators with their unit, limits and measurement kind.
PROGRAMME_PREFIX = "Välisõhu kvaliteedi"
GROUP = "Saasteained välisõhus"
UNITS = {
    "Lämmastikdioksiid": "µg/m³",
    "Peened osakesed (PM 10)": "µg/m³",
    "Eriti peened osakesed (PM 2,5)": "µg/m³",
    "Osoon": "µg/m³",
    "Vääveldioksiid": "µg/m³",
    "Süsinikoksiid": "mg/m³",
    "Benseen": "µg/m³",
    "Benso(a)püreen": "ng/m³",
    "Arseen": "ng/m³",
    "Kaadmium": "ng/m³",
    "Nikkel": "ng/m³",
    "Plii": "ng/m³",
}
INDICATIVE = ("Benseen", "Benso(a)püreen", "Arseen", "Kaadmium", "Nikkel", "Plii")
PM10 = "Peened osakesed (PM 10)"
LEVELS = (  # indicator, limit, limit from 2030, guideline
    ("Lämmastikdioksiid", 40.0, 20.0, 10.0),
    ("Peened osakesed (PM 10)", 40.0, 20.0, 15.0),
    ("Eriti peened osakesed (PM 2,5)", 25.0, 10.0, 5.0),
    ("Benseen", 5.0, 3.4, None),
    ("Benso(a)püreen", 1.0, 1.0, None),
    ("Arseen", 6.0, 6.0, None),
    ("Kaadmium", 5.0, 5.0, None),
    ("Nikkel", 20.0, 20.0, None),
    ("Plii", 500.0, 500.0, None),
)
CONTINUOUS_DAYS, INDICATIVE_DAYS = 0.75 * 365, 52
PM10_DAILY_LIMIT, PM10_ALLOWED_DAYS = 50.0, 35
VALUE, UNIT, NAME, PLACE, MARK = "vaartus_arv_moodetud", "naitaja_abr_unit", "naitaja_nimetus", "seirekoht_kood", "vaartus_erimark"


def has_air(df: DataFrame) -> bool:
    cols = ["naitaja_grupp_selg", "seiretoo_nimetus", PLACE, UNIT]
    return has_rows(df, cols, F.col("naitaja_grupp_selg") == GROUP)


def prepare(df: DataFrame) -> DataFrame:
    rows = df.where(
        (F.col("naitaja_grupp_selg") == GROUP)
        & F.col("seiretoo_nimetus").startswith(PROGRAMME_PREFIX)
        & F.col(VALUE).isNotNull()
        & F.col(NAME).isin(*UNITS)
    )
    return rows.withColumns({"day": text_day("seireaeg_algus"), "year": text_year("seireaeg_algus")})


def daily(df: DataFrame, keys: Sequence[str], value: str = "v", mark: str = MARK) -> DataFrame:
    """Daily mean and whether any value of the day carries a detection-limit mark."""
    return df.groupBy(*keys).agg(F.avg(value).alias("v"), F.bool_or(F.col(mark).isNotNull()).alias("below_loq"))


def station_years(day: DataFrame, keys: Sequence[str], need: Column, over: float = PM10_DAILY_LIMIT) -> DataFrame:
    """Annual mean, days, marked days and days over a limit, for years with enough days."""
    t = day.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("v").alias("mean"),
        F.count_if("below_loq").alias("loq_days"),
        F.count_if(F.col("v") > over).alias("over_limit"),
    )
    return t.where(F.col("days") >= need)


def by_year(sy: DataFrame, keys: Sequence[str], allowed: int = PM10_ALLOWED_DAYS) -> DataFrame:
    """Distribution of station means per year."""
    base = sy.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("stations"),
        F.min("mean").alias("min"),
        F.max("mean").alias("max"),
        F.sum("days").alias("days"),
        ratio(F.sum("loq_days"), F.sum("days")).alias("loq_share"),
        F.max("over_limit").alias("over_max"),
        F.count_if(F.col("over_limit") > allowed).alias("stations_above_allowed"),
    )
    return with_quantiles(base, sy, keys, "mean", {"median": (0.5, LINEAR)})


def programme_names(df: DataFrame, column: str = "seiretoo_nimetus") -> DataFrame:
    """Distinct programme names without a trailing year."""
    name = F.trim(F.regexp_replace(column, r"\s*\d{4}\.?\s*a?\.?\s*$", ""))
    return df.select(name.alias("programme")).distinct()


def build(df: DataFrame) -> dict[str, DataFrame]:
    d = prepare(df)
    used, left_out = target_unit_only(d, NAME, VALUE, UNIT, UNITS)
    need = F.when(F.col(NAME).isin(*INDICATIVE), float(INDICATIVE_DAYS)).otherwise(CONTINUOUS_DAYS)
    sy = station_years(daily(used, [NAME, PLACE, "year", "day"]), [NAME, PLACE, "year"], need)
    pm = F.col(NAME) == PM10
    years = by_year(sy, [NAME, "year"]).withColumns(
        {c: F.when(pm, F.col(c)) for c in ("over_max", "stations_above_allowed")}
    )
    levels = df.sparkSession.createDataFrame(list(LEVELS), f"`{NAME}` string, limit double, limit2030 double, who double")
    kinds = F.when(F.col(NAME).isin(*INDICATIVE), "indicative").otherwise("continuous")
    spec = years.select(NAME).distinct().withColumns({"unit": lookup(NAME, UNITS), "kind": kinds}).join(F.broadcast(levels), NAME, "left")
    return {
        "years": years,
        "paired": paired_ends(sy, [NAME], PLACE, "year", "mean"),
        "left_out": left_out,
        "levels": spec,
        "programmes": programme_names(d),
        "units": d.groupBy(UNIT).agg(F.count(F.lit(1)).alias("rows")),
    }
