"""Forest survey estimates: headline series, classes, changes and tiling checks with error propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import estimates as es
from tidemark.operators.profile import filter_trace, shape_examples, shape_values, table_shapes

#: Classifiers, names and table numbers of the source cube.
DIMS = (
    "maakategooria",
    "omand",
    "maakond",
    "majandkategooria",
    "enamuspuuliik",
    "filtri_tunnus1",
    "filter1",
    "filtri_tunnus2",
    "filter2",
    "filtri_tunnus3",
    "filter3",
)
LAND, STOCKED, ALL_STANDS = "Metsamaa", "Metsaga metsamaa", "Puistud"
SUM, MEAN = "Summa", "Keskmine"
AREA, VOLUME, GROWTH, FELLED, DEAD, LYING = "Pindala", "Kasvavate puude maht", "Juurdekasv", "Raiutud maht", "Kuivanud puude maht", "Lamapuidu maht"
CUTS = {"filtri_tunnus1": "Raieliik", "filter1": "Raied kokku", "filtri_tunnus2": "Raie aeg", "filter2": "Hooajaraie"}
MANAGEMENT_TOTAL, MANAGEMENT_PARTS = "Kokku mets", ("Majandusmets", "Majanduspiiranguga mets", "Rangelt kaitstav mets")
CHANGE_METRICS = ("area", "stock", "stock_per_ha", "increment", "deadwood_per_ha")


def _shape(table: int, indicator: str, calc: str = SUM, over: tuple[str, ...] = (), period: str | None = None, **fixed: str) -> es.Shape:
    select: dict[str, object] = {"tabeli_number": table, "tunnus": indicator, "arvutus": calc}
    if period is not None:
        select["periood"] = period
    return es.Shape(select, fixed, over)


def headline_shapes() -> dict[str, es.Shape]:
    stands = {"maakategooria": LAND, "enamuspuuliik": ALL_STANDS}
    return {
        "area": _shape(24, AREA, maakategooria=LAND),
        "area_stocked": _shape(1, AREA, maakategooria=STOCKED),
        "stock": _shape(24, VOLUME, maakategooria=LAND),
        "stock_per_ha": _shape(24, VOLUME, MEAN, maakategooria=LAND),
        "increment": _shape(6, GROWTH, **stands),
        "increment_per_ha": _shape(6, GROWTH, MEAN, **stands),
        "felling_5y": _shape(23, FELLED, period="5", maakategooria=LAND, **CUTS),
        "felling_3y": _shape(22, FELLED, period="3", maakategooria=LAND, **CUTS),
    }


def summed_shapes() -> dict[str, es.Shape]:
    return {
        "deadwood_standing": _shape(5351, DEAD, over=("omand",), maakategooria=LAND),
        "deadwood_lying": _shape(5351, LYING, over=("omand",), maakategooria=LAND),
    }


def national(df: DataFrame) -> DataFrame:
    """``(metric, year, value, err)`` of all headline series: one pass over the cube for all selections."""
    exact = es.series(es.label_metrics(df, DIMS, headline_shapes()), ["metric"])
    summed = es.total_over(es.series(es.label_metrics(df, DIMS, summed_shapes()), ["metric"]), ["metric", "year"])
    base = exact.unionByName(summed)

    def one(name: str) -> DataFrame:
        return base.where(F.col("metric") == name).drop("metric")

    def named(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("metric"), "year", "value", "err")

    dead = es.add(one("deadwood_standing"), one("deadwood_lying"))
    derived = (
        named("felling_to_increment_5y", es.ratio_of(one("felling_5y"), one("increment")))
        .unionByName(named("deadwood_total", dead))
        .unionByName(named("deadwood_per_ha", es.ratio_of(dead, one("area"))))
    )
    return base.unionByName(derived)


def by_class(df: DataFrame, table: int, indicator: str, dim: str, calc: str = SUM, skip: tuple[str, ...] = ()) -> DataFrame:
    """Series of every class of one classifier, all classes at once."""
    rows = es.exact(df, DIMS, _shape(table, indicator, calc, over=(dim,), maakategooria=LAND))
    rows = rows.where(~F.col(dim).isin(*skip)) if skip else rows
    return es.series(rows, [dim])


def counties(df: DataFrame) -> DataFrame:
    """Stock, stock per hectare and area per county, for counties with a stock per hectare."""
    shapes = {
        "stock": _shape(24, VOLUME, over=("maakond",), maakategooria=LAND),
        "stock_per_ha": _shape(24, VOLUME, MEAN, over=("maakond",), maakategooria=LAND),
        "area": _shape(24, AREA, over=("maakond",), maakategooria=LAND),
    }
    rows = es.series(es.label_metrics(df, DIMS, shapes), ["maakond", "metric"])
    return rows.join(rows.where(F.col("metric") == "stock_per_ha").select("maakond").distinct(), "maakond", "left_semi")


def age_structure(df: DataFrame, width: int = 20) -> DataFrame:
    """Area per age class of one class scheme; owners and species added with their errors."""
    aged = df.where((F.col("tabeli_number") == 13) & (F.col("filtri_tunnus2") == "Vanus"))
    scheme = es.age_class_set(aged, "filter2", width)
    shape = _shape(13, AREA, over=("omand", "enamuspuuliik", "filter2"), maakategooria=STOCKED, filtri_tunnus2="Vanus")
    rows = es.exact(aged, DIMS, shape).join(scheme, "filter2")
    return es.total_over(es.series(rows, ["filter2", "lower"]), ["filter2", "lower", "year"])


def tiling(nat: DataFrame, species: DataFrame, owners: DataFrame, management: DataFrame, age: DataFrame) -> DataFrame:
    """Do the classes add up to the stated total in the latest year?"""
    totals = es.latest_values(nat, ["metric"])

    def check(name: str, parts: DataFrame, dim: str, total: DataFrame) -> DataFrame:
        return es.shares_check(es.latest_values(parts, [dim]), total).select(F.lit(name).alias("check"), "share")

    metric = F.col("metric")
    kept = management.where(F.col("majandkategooria").isin(*MANAGEMENT_PARTS))
    whole = es.latest_values(management.where(F.col("majandkategooria") == MANAGEMENT_TOTAL), ["majandkategooria"])
    return (
        check("species_vs_stock", species, "enamuspuuliik", totals.where(metric == "stock"))
        .unionByName(check("owners_vs_area", owners, "omand", totals.where(metric == "area")))
        .unionByName(check("management_vs_total", kept, "majandkategooria", whole))
        .unionByName(check("age_vs_stocked_area", age, "filter2", totals.where(metric == "area_stocked")))
    )


def build(df: DataFrame) -> dict[str, DataFrame]:
    nat = national(df)
    species = by_class(df, 6, VOLUME, "enamuspuuliik", skip=(ALL_STANDS,))
    owners = by_class(df, 1, AREA, "omand")
    management = by_class(df, 4, AREA, "majandkategooria")
    age = age_structure(df)
    trace = _shape(13, AREA, over=("omand", "enamuspuuliik", "filter2"), maakategooria=STOCKED, filtri_tunnus2="Vanus")
    return {
        "national": nat,
        "changes": es.changes(nat.where(F.col("metric").isin(*CHANGE_METRICS)), ["metric"], 10),
        "species": species,
        "owners": owners,
        "management": management,
        "counties": counties(df),
        "age": age,
        "checks": tiling(nat, species, owners, management, age),
        "trace_age": filter_trace(df, trace.steps(DIMS)),
        "errors": es.error_summary(df),
    }


def diagnostics(df: DataFrame) -> dict[str, DataFrame]:
    """Shapes of the cube with their values and largest rows."""
    dims = [d for d in DIMS if d in df.columns]
    by = ["tabeli_number", "tunnus", "arvutus"]
    return {
        "shapes": table_shapes(df, dims, by, "aasta"),
        "values": shape_values(df, dims, by),
        "examples": shape_examples(df, dims, by, "aasta", "arvvaartus"),
        "errors": es.error_summary(df),
    }
