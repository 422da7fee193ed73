"""Nature conservation: protected areas, habitat and species versions, species sites, key habitats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import distinct_with_null, lookup, registration_year, sum0, version_label
from tidemark.operators.composition import running_totals
from tidemark.operators.transition import change_counts, first_and_last

#: Status words and rating scales.
KEEP = "kaitsealune"
CONSERVATION = {"Väga hästi säilinud": 1, "Hästi säilinud": 2, "Keskmiselt või vähe säilinud": 3}
SPECIES_CONSERVATION = {
    "Kaitsestaatus eeskujulik": 1,
    "Hea kaitsestaatus": 2,
    "Keskmine või vähenenud kaitsestaatus": 3,
}
CATEGORIES = ("I kategooria", "II kategooria", "III kategooria")
KEY_HABITAT, CONTRACT = "Vääriselupaik", "On kehtiv leping"
PROTECTED, ALIEN, INVASIVE = "Kaitsealune liik", "Võõrliik", "Invasiivne"
MISSING = "määramata"
YEARS = (1990, 2026)


def areas_by_type(
    df: DataFrame, keys: Sequence[str], kind: str, sums: Mapping[str, str], missing: str = MISSING, count: str | None = None
) -> DataFrame:
    """Rows and areas per type; types overlap on the ground, so they are never added up."""
    first = next(iter(sums.values()))
    extra = [F.count(first).alias(count)] if count else []
    return df.groupBy(*keys, F.coalesce(F.col(kind), F.lit(missing)).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), *[sum0(c).alias(n) for n, c in sums.items()], *extra
    )


def protected_areas(areas: DataFrame) -> dict[str, DataFrame]:
    status = F.when(F.col("al_staatus_selg").startswith(KEEP), "designated").otherwise("planned")
    d = areas.where(F.col("al_staatus_selg").isNotNull()).withColumn("status", status)
    sums = {"land_ha": "pindala_maa", "sea_ha": "pindala_meri"}
    return {
        "status": d.groupBy("status").agg(F.count(F.lit(1)).alias("n")),
        "by_type": areas_by_type(d, ["status"], "tyyp_selg", sums, count="n_land_area"),
        "by_iucn": areas_by_type(d.where(F.col("status") == "designated"), [], "iucn_tyyp_selg", sums, count="n_land_area"),
    }


def version_statistics(
    df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], area: str | None = None, rating: str = "cons"
) -> DataFrame:
    """Records, distinct members, area and rating counts per key."""
    r = F.col(rating)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        *[distinct_with_null(c).alias(n) for n, c in distinct.items()],
        *([sum0(area).alias("area")] if area else []),
        F.count(r).alias("rated"),
        *[F.count_if(r == k).alias(f"rated_{k}") for k in (1, 2, 3)],
    )


def _latest_version(df: DataFrame) -> DataFrame:
    last = df.agg(F.max("version").alias("__v"))
    return df.where(F.col("version") == last.scalar())


def habitats(rows: DataFrame) -> dict[str, DataFrame]:
    d = rows.where(~F.col("elupst_on_endine")).withColumns(
        {"version": version_label("elpst_tyyp_selg"), "cons": lookup("elupst_kaitse_selg", CONSERVATION)}
    )
    site = d.withColumn("site", F.concat_ws("|", "elpst_obj_id", "elupaigatyyp_kood"))
    site = site.where(F.col("elpst_obj_id").isNotNull() & F.col("elupaigatyyp_kood").isNotNull())
    both = first_and_last(site, "site", "version", "cons").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    return {
        "per_version": version_statistics(d, ["version"], {"sites": "elpst_obj_id", "habitat_types": "elupaigatyyp_kood"}, "elupst_pindala_alal"),
        "groups_latest": version_statistics(_latest_version(d), ["elupaigatyyp_grupp_selg"], {}, "elupst_pindala_alal"),
        "paired": change_counts(both, keys=("from", "to")),
    }


def species_versions(rows: DataFrame) -> dict[str, DataFrame]:
    d = rows.where(~F.col("lkohtst_on_endine")).withColumns(
        {"version": version_label("lkohtst_tyyp_selg"), "cons": lookup("lkohtst_kaitse_selg", SPECIES_CONSERVATION)}
    )
    return {
        "per_version": version_statistics(d, ["version"], {"species": "lkohtst_lnim_id", "sites": "lkohtst_obj_id"}),
        "by_group_latest": _latest_version(d).groupBy(F.coalesce("ryhm_selg", F.lit(MISSING)).alias("name")).agg(
            F.count(F.lit(1)).alias("records"), F.count_distinct("lkohtst_lnim_id").alias("species")
        ),
    }


def species_sites(rows: DataFrame) -> dict[str, DataFrame]:
    kind, cat = F.col("liik_tyyp_selg"), F.col("lnim_kaitsekategooria_selg")
    name = F.coalesce("lnim_ryhm_selg", F.lit(MISSING)).alias("name")
    by_cat = [F.count_if(cat == c).alias(c) for c in CATEGORIES]
    return {
        "totals": rows.agg(
            F.count(F.lit(1)).alias("total_sites"), F.count_if(kind == PROTECTED).alias("protected_species_sites"),
            F.count_if(kind == ALIEN).alias("alien_sites"), F.count_if(F.col("voorliik_tyyp_selg") == INVASIVE).alias("invasive_sites"),
            *[F.count_if((kind == PROTECTED) & (cat == c)).alias(c) for c in CATEGORIES],
        ),
        "by_group": rows.where(kind == PROTECTED).groupBy(name).agg(F.count(F.lit(1)).alias("sites"), distinct_with_null("lnim_id").alias("species"), *by_cat),
        "alien_by_group": rows.where(kind == ALIEN).groupBy(name).agg(F.count(F.lit(1)).alias("sites"), distinct_with_null("lnim_id").alias("species")),
    }


def key_habitats(rows: DataFrame) -> dict[str, DataFrame]:
    kh = rows.where(F.col("tyyp_selg") == KEY_HABITAT).withColumn("year", registration_year("esmane_kp"))
    contract = F.count_if(F.col("kaitse_selg") == CONTRACT)
    owned = kh.groupBy(F.coalesce("omandiv_selg", F.lit(MISSING)).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), sum0("pindala").alias("area_ha"), contract.alias("with_contract")
    )
    return {
        "totals": kh.agg(
            F.count(F.lit(1)).alias("n"), sum0("pindala").alias("area_ha"), contract.alias("with_contract"),
            F.count_if(F.col("year").isNull()).alias("year_unparsed"),
        ),
        "by_type": areas_by_type(kh, [], "veptyyp_selg", {"area_ha": "pindala"}),
        "by_year": running_totals(kh.where(F.col("year").between(*YEARS)), "year", "pindala"),
        "by_owner": owned,
    }


def build(
    areas: DataFrame, natura: DataFrame, habitat_rows: DataFrame, species_rows: DataFrame, sites: DataFrame, keys: DataFrame
) -> dict[str, DataFrame]:
    parts = {
        "protected": protected_areas(areas),
        "natura": {"sites": areas_by_type(natura, [], "tyyp_selg", {"land_ha": "pindala_maa", "sea_ha": "pindala_meri"})},
        "habitats": habitats(habitat_rows),
        "species": species_versions(species_rows),
        "species_sites": species_sites(sites),
        "key_habitats": key_habitats(keys),
    }
    return {f"{p}.{k}": df for p, group in parts.items() for k, df in group.items()}
