"""Breeding birds (chained index), large carnivores (reporting structure) and tree crowns (text classes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import bin_of, ratio, text_year, upper_bound
from tidemark.operators import chain_index as ci
from tidemark.operators.profile import duplicates
from tidemark.plans.monitoring import has_rows

#: Programmes, species, indicators, class edges.
BIRD_PROGRAMME, BIRD_FIRST_YEAR = "Haudelinnustiku punktloendused", 2010
PREDATOR_PROGRAMME = "^(Hundi|Karu|Ilvese)vaatlused"
PREDATORS = ("hunt", "pruunkaru", "ilves")
ALL_INDIVIDUALS, PREDATOR_FIRST_YEAR = "Liigi isendite arv", 2006
CROWN_INDICATOR = "Okka/lehekadu kogu võra ulatuses"
CROWN_EDGES = ((10.0, "none"), (25.0, "slight"), (60.0, "moderate"))
CROWN_CLASSES = ("none", "slight", "moderate", "severe")
PROGRAMME, SPECIES, PLACE, VALUE, START = "seiretoo_nimetus", "liik_est", "seirekoht_kood", "vaartus_arv_moodetud", "seireaeg_algus"


def has_birds(df: DataFrame) -> bool:
    return has_rows(df, [PROGRAMME, SPECIES, PLACE, VALUE], F.col(PROGRAMME).startswith(BIRD_PROGRAMME))


def prepare_birds(df: DataFrame) -> DataFrame:
    rows = df.where(
        F.col(PROGRAMME).startswith(BIRD_PROGRAMME) & (F.col(VALUE) >= 0) & F.col(SPECIES).isNotNull()
    )
    return rows.withColumn("year", text_year(START)).where(F.col("year") >= BIRD_FIRST_YEAR)


def build_birds(df: DataFrame, reps: int = ci.BOOTSTRAP) -> dict[str, DataFrame]:
    d = prepare_birds(df)
    out = ci.chained_index(d, SPECIES, PLACE, "year", VALUE, reps=reps)
    out["points_per_year"] = d.groupBy("year").agg(F.count_distinct(PLACE).alias("points"))
    return out


def has_predators(df: DataFrame) -> bool:
    return has_rows(df, [PROGRAMME, SPECIES, PLACE, "naitaja_nimetus"], F.col(PROGRAMME).rlike(PREDATOR_PROGRAMME))


def prepare_predators(df: DataFrame) -> DataFrame:
    rows = df.where(F.col(PROGRAMME).rlike(PREDATOR_PROGRAMME) & F.col(SPECIES).isin(*PREDATORS) & (F.col(VALUE) >= 0))
    return rows.withColumn("year", text_year(START)).where(F.col("year") >= PREDATOR_FIRST_YEAR)


def effort(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Reporting places and observations per key."""
    return df.groupBy(*keys).agg(F.count_distinct(place).alias("districts"), F.count(F.lit(1)).alias("observations"))


def indicator_span(df: DataFrame, keys: Sequence[str], place: str, year: str = "year") -> DataFrame:
    """Rows, reporting places and year range per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(place).alias("districts"),
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
    )


def build_predators(df: DataFrame) -> dict[str, DataFrame]:
    d = prepare_predators(df)
    return {
        "effort": effort(d.where(F.col("naitaja_nimetus") == ALL_INDIVIDUALS), [SPECIES, "year"], PLACE),
        "by_indicator": indicator_span(d, [SPECIES, "naitaja_nimetus"], PLACE),
        "checks": effort(d, ["naitaja_nimetus"], PLACE),
    }


def prepare_crowns(df: DataFrame) -> DataFrame:
    d = df.where(F.col("naitaja_nimetus") == CROWN_INDICATOR)
    d = d.withColumns({"year": text_year(START), "upper": upper_bound("vaartus_muu")})
    return d.withColumn("cls", bin_of("upper", CROWN_EDGES, "severe"))


def damage_by_year(
    df: DataFrame, year: str = "year", species: str = SPECIES, place: str = PLACE, classes: Sequence[str] = CROWN_CLASSES,
    damaged: Sequence[str] = ("moderate", "severe"),
) -> DataFrame:
    """Trees, plots, class counts, damaged share and mean class bound per year, in total and per species."""
    rows = df.where(F.col("cls").isNotNull())
    return rows.groupingSets([[year], [year, species]], year, species).agg(
        F.grouping(species).cast("int").alias("all_species"),
        F.count(F.lit(1)).alias("trees"),
        F.count_distinct(place).alias("plots"),
        *[F.count_if(F.col("cls") == c).alias(c) for c in classes],
        ratio(F.count_if(F.col("cls").isin(*damaged)), F.count(F.lit(1))).alias("share_damaged"),
        F.avg("upper").alias("mean_upper"),
    )


def crown_checks(d: DataFrame) -> dict[str, DataFrame]:
    numbered = d.where(F.col("isend_nr").isNotNull())
    unparsed = d.where(F.col("upper").isNull())
    return {
        "rows": d.agg(
            F.count(F.lit(1)).alias("rows"),
            ratio(F.count_if(F.col("isend_nr").isNull()), F.count(F.lit(1))).alias("tree_number_null_share"),
            F.count_if(F.col("upper").isNull()).alias("not_assessed_or_unparsed"),
        ),
        "unparsed_labels": unparsed.groupBy("vaartus_muu").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "vaartus_muu").limit(10),
        "duplicates": duplicates(numbered, ["year", PLACE, "isend_nr", SPECIES]),
    }


def build_crowns(df: DataFrame, top: int = 8) -> dict[str, DataFrame]:
    d = prepare_crowns(df)
    species = d.groupBy(SPECIES).agg(F.count(F.lit(1)).alias("trees")).orderBy(F.desc("trees"), SPECIES).limit(top)
    return {"by_year": damage_by_year(d), "species_in_data": species, **{f"check_{k}": v for k, v in crown_checks(d).items()}}
