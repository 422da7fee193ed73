"""Facility emissions and heat: unit screening, sector folding, concentration and ratio outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import keyword_label
from tidemark.functions.ranks import top_rows
from tidemark.operators import composition as comp
from tidemark.operators import profile as pf
from tidemark.operators.hydrology import link_series
from tidemark.operators.screening import convert_units, ratio_outliers

#: Units, substances, fuel groups.
TO_TONNES = {"t": 1.0, "kg": 1e-3, "mg": 1e-9}
CO2, CO2_BIO = "CO2", "CO2 bio"
POLLUTANTS = ("NO2", "SO2", "NH3", "CO", "LOÜ", "PM10", "PM2,5")
FUEL_GROUPS = (
    ("Puit ja biomass", ("puidu", "küttepuud", "puidugraan", "hake", "biogaas", "must leelis")),
    ("Põlevkivi", ("põlevkivi keevkihtpõletamisel", "põlevkivi tolmpõletamisel")),
    ("Põlevkiviõli", ("põlevkiviõli",)),
    ("Maagaas", ("maagaas",)),
    ("Tööstus- ja muud gaasid", ("generaatorgaas", "poolkoksigaas", "muud gaaskütused")),
    ("Turvas", ("turvas",)),
    ("Jäätmed", ("olmejäätmed", "jäätmed")),
    ("Nafta- ja veeldatud gaasid", ("diisel", "kütteõli", "veeldatud", "lpg", "lng", "bensiin")),
)
OTHER, UNKNOWN = "Muu", "teadmata"
YEAR, REPORT, GROUP, SOURCE, NAME, FUEL = "aruanne_aasta", "aruanne_id", "aine_stat_grupp", "heiteallikas_kood", "aine_nimetus", "kytus_kood"
AMOUNT, UNIT = "aine_kogus_maarus_yhik", "aine_yhik_maarus"
ROW_KEY = (REPORT, SOURCE, NAME, FUEL)


def prepare_emissions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("ets", F.coalesce("ets_kohuslane", F.lit(UNKNOWN)))
    return convert_units(marked, AMOUNT, UNIT, TO_TONNES, "amount_t")


def prepare_heat(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows with their fuel group, and the flagged heat per year."""
    d = df.withColumn("fuel", keyword_label("kytus_nimetus_val", FUEL_GROUPS, OTHER))
    marked, clean = ratio_outliers(d, ["kytus_nimetus_val", "kytus_yhik"], "soojus_kokku", "kytus_kogus")
    flagged = F.col("no_base") | F.col("off_ratio")
    report = marked.groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(flagged).alias("flagged_rows"), F.sum(F.when(flagged, F.col("soojus_kokku"))).alias("flagged_heat")
    )
    return clean, report


def build(
    emissions: DataFrame, heat: DataFrame, climate: DataFrame | None = None, row_order: Sequence[str] = (AMOUNT,)
) -> dict[str, DataFrame]:
    """All sections; ``row_order`` fixes which row of a repeated key counts as the first."""
    em, dropped = prepare_emissions(emissions)
    clean, flagged = prepare_heat(heat)
    main = em.where(F.col(GROUP).isin(CO2, CO2_BIO, *POLLUTANTS))
    nfr = F.coalesce("tegevusala_nfr", F.lit(UNKNOWN))
    sectors = None
    for g in (CO2, "NO2", "NH3"):
        part = comp.fold_rest(main.where(F.col(GROUP) == g).withColumn("sector", nfr), [YEAR], "sector", "amount_t", 8, OTHER).withColumn(GROUP, F.lit(g))
        sectors = part if sectors is None else sectors.unionByName(part)
    county = F.coalesce("tegevuskoht_maakond_nimi_curr", F.lit(UNKNOWN)).alias("county")
    by_fuel = clean.groupBy(YEAR, "fuel").agg(
        F.sum("soojus_kokku").alias("heat"), F.sum("elekter_kokku").alias("electricity"), F.count_distinct(REPORT).alias("reports")
    )
    total = clean.groupBy(F.col(YEAR).alias("year")).agg(F.sum("soojus_kokku").alias("heat"))
    out = {
        "coverage": em.groupBy(YEAR).agg(F.count_distinct(REPORT).alias("reports")),
        "totals": comp.group_totals(main, [YEAR, GROUP], "amount_t", "tonnes", REPORT),
        "sectors": sectors,
        "counties": main.where(F.col(GROUP).isin(CO2, "NO2")).groupBy(YEAR, GROUP, county).agg(F.sum("amount_t").alias("tonnes")),
        "ets": main.where(F.col(GROUP) == CO2).groupBy(YEAR, "ets").agg(F.sum("amount_t").alias("tonnes")),
        "concentration": comp.concentration(main.where(F.col(GROUP).isin(CO2, "NO2", "SO2")), [GROUP, YEAR], REPORT, "amount_t"),
        "sensitivity": comp.dedup_gap(main, ROW_KEY, [YEAR, GROUP], "amount_t", row_order),
        "by_fuel": by_fuel,
        "heat_total": total,
        "dropped_units": dropped,
        "flagged_heat": flagged,
    }
    if climate is not None:
        out["climate_link"], _ = link_series(total, climate, "year", "heat", "value", 4, reps=0)
    return out


def diagnostics(emissions: DataFrame, heat: DataFrame, row_order: Sequence[str] = (AMOUNT,)) -> dict[str, DataFrame]:
    """Grain of both tables: units, repeated fuel amounts, duplicate keys, additivity of heat and electricity."""
    em, dropped = convert_units(emissions, AMOUNT, UNIT, TO_TONNES, "amount_t")
    attributes = {
        n: c
        for n, c in {
            "differing_permit_versions": "luba_versioon", "differing_cas": "cas_kood", "differing_stat_group": GROUP, "differing_method": "aine_arvestus_meetod",
        }.items()
        if c in emissions.columns
    }
    out = {
        "rows_by_year": emissions.groupBy(YEAR).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(REPORT).alias("reports")),
        "unknown_units": dropped,
        "groups": em.groupBy(GROUP).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(NAME).alias("names"), F.min(NAME).alias("example"), F.sum("amount_t").alias("total_t")),
        "duplicate_keys": pf.duplicates(emissions, ROW_KEY),
        "differences": pf.repeated_key_differences(em, ROW_KEY, "amount_t", attributes, row_order),
        "heat_additivity": pf.additivity(heat, REPORT, ["soojus_kokku", "elekter_kokku"]),
        "report_level_totals": pf.per_key_totals(heat, REPORT, YEAR, ["soojus_kokku", "elekter_kokku"]),
        "top_heat_rows": top_rows(heat, [], [F.desc_nulls_last("soojus_kokku"), F.asc(REPORT)], 12),
    }
    if "kytus_kogus" in emissions.columns:
        fuel = emissions.where(F.col(FUEL).isNotNull())
        out["fuel_repeats"] = pf.repeats(fuel, [REPORT, SOURCE, FUEL], "kytus_kogus")
    return out
