"""Official-statistics themes: energy balance, heat, greenhouse gases and circular economy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators import cubes
from tidemark.operators.climatology import index_to_base, index_to_first_common

#: Item and product codes of the energy tables.
TOTAL = "TOTAL"
RENEWABLE = ("RA100", "RA300", "RA420", "R5110-5150_W6000RI", "R5300", "W6210", "R5210P", "R5210B", "R5220P", "R5220B")
PRODUCTION_GROUPS = {
    "Põlevkivi": ("S2000",),
    "Turvas": ("P1100", "P1200"),
    "Biomass ja biogaas": ("R5110-5150_W6000RI", "R5300", "W6210", "R5210P", "R5210B", "R5220P"),
    "Tuul, päike, hüdro": ("RA100", "RA300", "RA420"),
}
FINAL_SECTORS = {
    "FC_IND_E": "Tööstus",
    "FC_TRA_E": "Transport",
    "FC_OTH_HH_E": "Kodumajapidamised",
    "FC_OTH_CP_E": "Äri- ja avalik sektor",
}
ELECTRICITY_GROUPS = {
    "Põlevkivi ja põlevkiviproduktid": ("S2100_EE", "O4510_EE", "C0361_EE"),
    "Tuul": ("WIND",),
    "Päike": ("SOLAR",),
    "Hüdro": ("HYDRO",),
    "Biomass, biogaas, muu taastuv": ("B5115_EE", "B5300", "N9940_EE"),
    "Maagaas": ("G3000",),
}
ELECTRICITY_RENEWABLE = ("WIND", "SOLAR", "HYDRO", "B5115_EE", "B5300", "N9940_EE")
BALANCE_ITEMS = {"PPRD": "production", "IMP": "imports", "EXP": "exports", "STK_CHG": "stock_change", "GAE": "gae", "GIC": "gic", "FC_E": "final"}
REST = "Muu"
#: Heat tables.
ALL_GENERATORS = "CHP_T"
HEAT_FUELS = {
    "Põlevkivi ja põlevkiviproduktid": ("S2100_EE", "O4510_EE", "C0361_EE"),
    "Maagaas": ("G3000X3100_3200",),
    "Biomass ja biogaas": ("B51151_EE", "B5110_W_NVA", "B5300"),
    "Kivisüsi ja turvas": ("C0100", "P1120"),
    "Jäätmekütus": ("W6220_EE",),
    "Muud taastuvad": ("N9940_EE",),
}
HEAT_RENEWABLE = ("B51151_EE", "B5110_W_NVA", "B5300", "N9940_EE")
CHP_ITEMS = ("PROD_E_CHP", "PROD_H_CHP", "CAP_E", "CAP_H")
TERAJOULE_PER_GWH = 3.6
#: Greenhouse-gas categories.
GAS_TOTAL, GAS_TOTAL_WITH_LAND, LAND_USE, ENERGY_SECTOR = "TOTX4_MEMO", "TOTXMEMO", "CRF4", "CRF1"
GAS_MAIN = {
    "CRF1": "Energia",
    "CRF2": "Tööstusprotsessid ja tootekasutus",
    "CRF3": "Põllumajandus",
    "CRF5": "Jäätmed",
}
GAS_ENERGY = {
    "CRF1A1": "Energiatööstus (elekter, soojus, rafineerimine)",
    "CRF1A2": "Töötlev tööstus ja ehitus",
    "CRF1A3": "Transport",
    "CRF1A4": "Kodumajapidamised, teenindus, põllumajandus",
    "CRF1B": "Fugitiivsed heited",
}
#: Circular economy items.
MATERIAL_ITEMS = {"2": "extraction", "9": "dmc", "10": "dmc_per_capita", "11": "resource_productivity", "14": "material_intensity"}
WASTE_ITEMS = {"3": "generated", "7": "recovery", "8": "disposal", "9": "landfilled", "6": "treated"}
EXCLUDED_CHAPTERS = ("01", "10")
YEAR, ITEM, PRODUCT, PRODUCER, PERIOD, GENERATOR = "Aasta", "Näitaja", "Kütuse/energia liik", "Elektritootja liik", "Vaatlusperiood", "Generaatori liik"


def with_share(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    return df.withColumn(out, F.lit(100.0) * ratio(part, total))


def build_energy(balance: DataFrame, electricity: DataFrame, capacity: DataFrame) -> dict[str, DataFrame]:
    b = balance.withColumnsRenamed({YEAR: "year", ITEM: "item", PRODUCT: "product"}).withColumn("year", F.col("year").try_cast("int"))
    is_total = F.col("product") == TOTAL
    items = cubes.align(b.where(is_total), "year", "item", "value", BALANCE_ITEMS)
    signs = cubes.detect_signs(items, "gae", ["production", "imports"], ("exports", "stock_change"))
    made = b.where(F.col("item") == "PPRD")
    el = electricity.where((F.col(ITEM) == "PROD_E") & (F.col(PRODUCER) == "_T"))
    sources = cubes.group_pivot(
        el, YEAR, PRODUCT, "value", ELECTRICITY_GROUPS, F.col(PRODUCT) == "_T", REST, {"renewable": ELECTRICITY_RENEWABLE}
    )
    final = {**FINAL_SECTORS, "FC_E": "total"}
    return {
        "signs": signs,
        "balance": cubes.balance_rows(items, signs),
        "production": cubes.group_pivot(made, "year", "product", "value", PRODUCTION_GROUPS, is_total, REST, {"renewable": RENEWABLE}),
        "renewable_gae": cubes.share_of_total(b.where(F.col("item") == "GAE"), "year", "value", F.col("product").isin(*RENEWABLE), is_total),
        "final": cubes.align(b.where(is_total), "year", "item", "value", final).where(F.col("total").isNotNull()),
        "electricity": with_share(sources, "renewable", "total", "renewable_share_pct"),
        "capacity": capacity.where((F.col(PRODUCER) == "_T") & F.col("value").isNotNull())
        .groupBy(F.col(PERIOD).try_cast("int").alias("year"), F.col(ITEM).alias("item"))
        .agg(F.sum("value").alias("value")),
    }


def build_heat(chp: DataFrame, fuels: DataFrame, monthly: DataFrame) -> dict[str, DataFrame]:
    chp, fuels, monthly = (cubes.clean_names(x) for x in (chp, fuels, monthly))
    all_gen = F.col(GENERATOR) == ALL_GENERATORS
    items = cubes.align(chp.where(all_gen), PERIOD, ITEM, "value", {c: c for c in CHP_ITEMS})
    by_gen = chp.where(~all_gen & (F.col(ITEM) == "PROD_H_CHP")).withColumn("year", F.col(PERIOD).try_cast("int"))
    burnt = fuels.where(all_gen & (F.col(ITEM) == "CONS_FUEL_NRG"))
    f = cubes.group_pivot(burnt, PERIOD, PRODUCT, "value", HEAT_FUELS, F.lit(True), REST, {"renewable": HEAT_RENEWABLE})
    output = (F.col("PROD_E_CHP") + F.col("PROD_H_CHP")) * TERAJOULE_PER_GWH
    f = with_share(f, "renewable", "total", "renewable_share_pct").join(items, "year", "left").withColumn("output_to_fuel", ratio(output, "total"))
    t = monthly.where((F.col(ITEM) == "PROD") & F.col("value").isNotNull()).withColumns(
        {"year": F.substring(PERIOD, 1, 4).try_cast("int"), "month": F.substring(PERIOD, 6, 2).try_cast("int"), "kind": F.col("Energia liik")}
    )
    full = cubes.complete_years(t, ["kind"], "year", "value")
    heat = F.col("kind") == "H8000"
    return {
        "chp": items.join(cubes.map_of(by_gen, ["year"], GENERATOR, "value", "heat_by_generator"), "year", "left"),
        "fuels": f.drop(*CHP_ITEMS),
        "annual": cubes.align(full, "year", "kind", "total", {"H8000": "heat_gwh", "E7000": "electricity_gwh"}),
        "profile": cubes.recent_profiles(t.where(heat), full.where(heat), [], "year", "month", "value"),
        "last_month": t.agg(F.max(PERIOD).alias("last_month")),
    }


def build_gases(df: DataFrame, home: str = "EE", peers: str = "EU27_2020", base: int = 1990) -> dict[str, DataFrame]:
    own = df.where(F.col("geo") == home)

    def rows(codes: Mapping[str, str], total: str) -> DataFrame:
        return cubes.column_pivot(own, "time", "src_crf", "value", codes, total, REST)

    series = F.when((F.col("geo") == home) & (F.col("src_crf") == GAS_TOTAL), "own_total")
    series = series.when((F.col("geo") == peers) & (F.col("src_crf") == GAS_TOTAL), "peer_total")
    series = series.when((F.col("geo") == home) & (F.col("src_crf") == ENERGY_SECTOR), "own_energy")
    tagged = df.withColumns({"series": series, "year": F.col("time").try_cast("int")}).where(F.col("series").isNotNull())
    indexed = index_to_base(tagged, "series", "year", "value", base)
    land = cubes.align(own, "time", "src_crf", "value", {LAND_USE: "lulucf", GAS_TOTAL_WITH_LAND: "total_incl"})
    return {
        "sectors": rows(GAS_MAIN, GAS_TOTAL),
        "energy": rows(GAS_ENERGY, ENERGY_SECTOR),
        "comparison": cubes.align(indexed, "year", "series", "index", {s: s for s in ("own_total", "peer_total", "own_energy")}).where(
            F.col("own_total").isNotNull()
        ),
        "lulucf": land.where(F.col("total_incl").isNotNull()),
    }


def build_circular(
    materials: DataFrame, waste: DataFrame, activity: DataFrame, gdp: DataFrame, reuse: DataFrame, waste_labels: DataFrame, activity_labels: DataFrame
) -> dict[str, DataFrame]:
    mat = cubes.align(materials, YEAR, ITEM, "value", MATERIAL_ITEMS)
    gdp_series = cubes.slice_series(gdp, {"Kvartal": "1", "Sesoonne korrigeerimine": "1", ITEM: "2"}, YEAR)
    chapters = cubes.chapter_codes(waste_labels)
    w = cubes.with_and_without(waste, chapters, YEAR, "Jäätmeliik", ITEM, "value", WASTE_ITEMS, "1", EXCLUDED_CHAPTERS)
    act = "Tegevusala (EMTAK 2008)"
    done = activity.where((F.col("Jäätmeliik") == "1") & F.col("value").isNotNull()).withColumn("year", F.col(YEAR).try_cast("int"))
    whole = F.col(act) == "1"

    def as_series(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.select(F.lit(name).alias("series"), "year", value.alias("value"))

    stacked = (
        as_series("gdp", gdp_series, F.col("value"))
        .unionByName(as_series("dmc", mat, F.col("dmc")))
        .unionByName(as_series("waste", w, F.col("generated")))
        .unionByName(as_series("waste_other", w, F.col("generated_other")))
    )
    return {
        "materials": mat,
        "gdp": gdp_series,
        "waste": w,
        "decoupling": index_to_first_common(stacked, "series", "year", "value", ["gdp", "dmc", "waste"]),
        "activity_total": done.where(whole).groupBy("year").agg(F.sum("value").alias("total")),
        "activity": cubes.labelled(done.where(~whole), activity_labels.withColumnRenamed("code", "code"), act).select("year", "name", "value"),
        "cmu": cubes.align(reuse.where(F.col("unit") == "PC"), "time", "geo", "value", {"EE": "ee", "EU27_2020": "eu"}),
    }
