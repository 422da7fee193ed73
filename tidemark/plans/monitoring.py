"""Catalogue reports over the stored aggregate of a long measurement table, and section guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import distinct_with_null
from tidemark.operators.mergeable import catalogue_of

PROGRAMME, GROUP, CODE, NAME, UNIT, SPECIES = (
    "seiretoo_seotud_programmi_nimi_i",
    "naitaja_grupp_selg",
    "naitaja_kood",
    "naitaja_nimetus",
    "naitaja_abr_unit",
    "liik_est",
)


def by_programme(parts: DataFrame) -> DataFrame:
    return catalogue_of(parts, [PROGRAMME], distinct={"indicators": CODE, "species": SPECIES}).orderBy(F.desc("rows"))


def by_indicator(
    parts: DataFrame,
    keys: Sequence[str] = (PROGRAMME, GROUP, CODE, NAME),
    unit: str = UNIT,
    species: str = SPECIES,
    top: int | None = None,
) -> DataFrame:
    """Indicators with years, sorted units, species, value range and negatives; a listing may ask for the ``top`` largest."""
    units = F.array_sort(F.collect_set(unit))  # the unit vocabulary of one indicator
    out = parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("n_value").alias("n_value"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_distinct("year").alias("years"),
        units.alias("units"),
        distinct_with_null(species).alias("species"),
        F.min("v_min").alias("v_min"),
        F.max("v_max").alias("v_max"),
        F.sum("n_negative").alias("negatives"),
    )
    return out.orderBy(F.desc("rows"), *[F.asc_nulls_first(k) for k in keys]).limit(top) if top else out


def rows_by_group_and_year(parts: DataFrame, group: str = GROUP, year: str = "year") -> DataFrame:
    """Rows per group and year together with the rows per year over all groups (one grouping-sets pass)."""
    return parts.groupingSets([[group, year], [year]], group, year).agg(
        F.sum("rows").alias("rows"), F.grouping(group).alias("all_groups")
    )


def species_overview(parts: DataFrame, top: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Species per year, and rows per species, programme and indicator (all, or a listing of the ``top`` largest)."""
    sp = parts.where(F.col(SPECIES).isNotNull())
    per_year = sp.groupBy("year").agg(F.sum("rows").alias("rows"), F.count_distinct(SPECIES).alias("species"))
    pairs = catalogue_of(sp, [SPECIES, PROGRAMME, NAME])
    return per_year, pairs.orderBy(F.desc("rows"), SPECIES, PROGRAMME, NAME).limit(top) if top else pairs


def group_coverage(by_group_year: DataFrame, group: str = GROUP, unknown: str = "unknown") -> DataFrame:
    """Rows, year span and number of years per indicator group."""
    return by_group_year.groupBy(F.coalesce(F.col(group), F.lit(unknown)).alias("name")).agg(
        F.sum("rows").alias("rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count_distinct("year").alias("years"),
    )


def catalogue(parts: DataFrame) -> dict[str, DataFrame]:
    per_year, pairs = species_overview(parts)
    return {
        "programmes": by_programme(parts),
        "indicators": by_indicator(parts),
        "groups_by_year": rows_by_group_and_year(parts),
        "species_per_year": per_year,
        "species_indicators": pairs,
    }


def coverage(sections: Mapping[str, DataFrame], first_year: int = 1990, top: int | None = None) -> dict[str, DataFrame]:
    """Reader-facing coverage: groups, rows and species per recent year, indicators counting many species."""
    grouped = sections["groups_by_year"]
    recent = F.col("year") >= first_year
    many = sections["indicators"].where((F.col("species") >= 5) & F.lower(F.col(NAME)).contains("arv"))
    return {
        "groups": group_coverage(grouped.where(F.col("all_groups") == 0)),
        "rows_by_year": grouped.where((F.col("all_groups") == 1) & recent).select("year", "rows"),
        "species_per_year": sections["species_per_year"].where(recent),
        "species_indicators": many.orderBy(F.desc("rows")).limit(top) if top else many,
    }


def has_rows(df: DataFrame, columns: Sequence[str], condition: Column) -> bool:
    """Do the columns exist and does at least one row meet the condition (stops at the first hit)?"""
    if not set(columns) <= set(df.columns):
        return False
    return not df.where(condition).limit(1).isEmpty()


def build(measurements: DataFrame, reps: int = 300) -> dict[str, DataFrame]:
    """Every theme the long measurement table has rows for; a theme without its columns or rows is left out."""
    from tidemark.plans import air, soil_water, species

    def present(columns: Sequence[str], condition: Column) -> bool:
        return has_rows(measurements, columns, condition)

    themes = {
        "crowns": (present([NAME, "vaartus_muu"], F.col(NAME) == species.CROWN_INDICATOR), species.build_crowns),
        "soil": (
            present(["seiretoo_nimetus", "naitaja_proovimaatriks_nimi"], F.col("seiretoo_nimetus").startswith(soil_water.SOIL_PROGRAMME)),
            soil_water.build_soil,
        ),
        "air": (air.has_air(measurements), air.build),
        "predators": (species.has_predators(measurements), species.build_predators),
        "birds": (species.has_birds(measurements), lambda df: species.build_birds(df, reps)),
        "water": (
            present([NAME, "pohjaveekogum_kood", "seirekogum_tyyp"], F.col(NAME).isin(soil_water.NO3, soil_water.NO3N, *soil_water.NUTRIENTS)),
            soil_water.build_water,
        ),
    }
    out: dict[str, DataFrame] = {}
    for theme, (there, make) in themes.items():
        if there:
            out.update({f"{theme}.{k}": v for k, v in make(measurements).items()})
    return out
