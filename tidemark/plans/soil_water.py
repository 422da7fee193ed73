"""Soil periods and water quality: unit rules per indicator, period and site statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, lookup, period_label, text_year
from tidemark.functions.ranks import top_rows
from tidemark.operators.transition import paired_periods, period_summary, two_level_limit

#: Soil programme, matrix, indicators, units.
SOIL_PROGRAMME, SOIL_MATRIX, SOIL_FIRST_YEAR, SOIL_PERIOD = "Mullaseire", "Muld, pinnas", 2002, 5
SOIL_UNITS = {
    "pH": "",
    "Orgaaniline süsinik": "% KA",
    "Huumussisaldus": "% KA",
    "Fosfor": "mg/kg",
    "Kaalium": "mg/kg",
    "Vask": "mg/kg",
    "Tsink": "mg/kg",
    "Plii": "mg/kg",
    "Kaadmium": "mg/kg",
    "Kroom": "mg/kg",
    "Nikkel": "mg/kg",
    "Elavhõbe": "mg/kg",
    "Arseen": "mg/kg",
}
TO_MG_KG = {"mg/kg KA": 1.0, "ppm": 1.0, "µg/kg KA": 1e-3, "ppb": 1e-3, "% KA": 1e4}
PH_RANGE = (2.0, 10.0)
#: Water indicators, units, categories and limit.
NO3, NO3N = "Nitraat (NO3)", "Nitraatlämmastik (NO3N)"
NO3_FACTOR = 62.004 / 14.007
NUTRIENTS = {"Üldlämmastik": "tn", "Üldfosfor": "tp"}
UNIT_TO_MG = {
    "tn|mg/l": 1.0,
    "tn|mgN/l": 1.0,
    "tn|µg/l": 1e-3,
    "tn|mg/m³": 1e-3,
    "tn|µmolN/l": 0.014007,
    "tp|mg/l": 1.0,
    "tp|mgP/l": 1.0,
    "tp|µg/l": 1e-3,
    "tp|mg/m³": 1e-3,
    "tp|µmolP/l": 0.030974,
}
NITRATE_LIMIT = 50.0
CATEGORIES = {"V": "Vooluveekogu", "S": "Seisuveekogu", "R": "Rannikuvesi"}
NAME, UNIT, VALUE, PLACE, MARK, START = (
    "naitaja_nimetus", "naitaja_abr_unit", "vaartus_arv_moodetud", "seirekoht_kood", "vaartus_erimark", "seireaeg_algus",
)


def prepare_soil(df: DataFrame) -> DataFrame:
    rows = df.where(
        F.col("seiretoo_nimetus").startswith(SOIL_PROGRAMME)
        & (F.col("naitaja_proovimaatriks_nimi") == SOIL_MATRIX)
        & F.col(VALUE).isNotNull()
        & F.col(NAME).isin(*SOIL_UNITS)
    )
    d = rows.withColumn("year", text_year(START)).where(F.col("year") >= SOIL_FIRST_YEAR)
    return d.withColumn("period", period_label("year", SOIL_FIRST_YEAR, SOIL_PERIOD))


def soil_values(d: DataFrame) -> DataFrame:
    """Comparable values of all indicators at once: pH in range, others in mg/kg or % of dry matter."""
    x = F.col(VALUE)
    mg = x * lookup(UNIT, TO_MG_KG)
    percent = lookup(NAME, SOIL_UNITS) == "% KA"
    v = F.when(F.col(NAME) == "pH", F.when(x.between(*PH_RANGE), x)).when(percent, mg / 1e4).otherwise(mg)
    return d.withColumn("v", v).where(F.col("v").isNotNull() & ((F.col(NAME) == "pH") | (F.col("v") >= 0)))


def methods(df: DataFrame, keys: Sequence[str], method: str = "analyys_meetod_nimi", top: int = 5) -> DataFrame | None:
    """Most used methods per key with their year range; none when the column is absent."""
    if method not in df.columns:
        return None
    g = df.groupBy(*keys, method).agg(
        F.count(F.lit(1)).alias("rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year")
    )
    return top_rows(g, keys, [F.desc("rows"), F.asc_nulls_first(method)], top, "rank")


def build_soil(df: DataFrame, min_plots: int = 20) -> dict[str, DataFrame]:
    g = soil_values(prepare_soil(df))
    out = {
        "periods": period_summary(g, [NAME, "period"], "v", PLACE, MARK),
        "paired": paired_periods(g, [NAME], PLACE, "period", "v", min_plots),
    }
    used = methods(g, [NAME])
    if used is not None:
        out["methods"] = used
    return out


def prepare_water(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "year": text_year(START),
            "category": lookup(F.substring("seirekogum_tyyp", 1, 1), CATEGORIES),
            "groundwater": F.col("pohjaveekogum_kood").isNotNull(),
        }
    )


def nitrate(df: DataFrame) -> DataFrame:
    """Groundwater nitrate as mg NO3/l; nitrogen rows are converted, other units left out."""
    name, unit, x = F.col(NAME), F.col(UNIT), F.col(VALUE)
    ok = ((name == NO3N) & unit.isin("mg/l", "mgN/l")) | ((name == NO3) & (unit == "mg/l"))
    rows = df.where(name.isin(NO3, NO3N) & F.col("groundwater") & (x >= 0) & ok)
    return rows.withColumn("no3", x * F.when(name == NO3N, NO3_FACTOR).otherwise(1.0))


def nutrients(df: DataFrame) -> DataFrame:
    """Surface-water nutrients in mg/l with the nutrient as a key."""
    key = lookup(NAME, NUTRIENTS)
    factor = lookup(F.concat_ws("|", key, F.col(UNIT)), UNIT_TO_MG)
    d = df.where(F.col("category").isNotNull() & ~F.col("groundwater") & (F.col(VALUE) >= 0))
    return d.withColumns({"nutrient": key, "mg": F.col(VALUE) * factor}).where(F.col("mg").isNotNull() & F.col("nutrient").isNotNull())


def build_water(df: DataFrame) -> dict[str, DataFrame]:
    d = prepare_water(df)
    no3 = nitrate(d)
    all_no3 = d.where(F.col(NAME).isin(NO3, NO3N) & F.col("groundwater"))
    used = no3.agg(F.count(F.lit(1)).alias("rows_used"))
    surface = period_summary(nutrients(d), ["nutrient", "category", "year"], "mg", PLACE, None, (0.25, 0.75), 5)
    return {
        "groundwater_nitrate": two_level_limit(no3, ["year"], PLACE, "no3", NITRATE_LIMIT, MARK),
        "nitrate_rows": attach(all_no3.agg(F.count(F.lit(1)).alias("rows")), used).select(
            "rows_used", (F.col("rows") - F.col("rows_used")).alias("rows_excluded")
        ),
        "surface": surface.withColumnRenamed("plots", "sites"),
        "units": d.groupBy(UNIT).agg(F.count(F.lit(1)).alias("rows")),
        "categories": d.groupBy("category").agg(F.count(F.lit(1)).alias("rows")),
    }
