"""Guards, preparations and documents of the themes over measurements made of the lines' own values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import registration_year
from tidemark.operators import cubes
from tidemark.plans import air, soil_water, species, waste
from tidemark.plans.queries.registry import query, rounded, table
from tidemark.sources.landed import read_or_empty

PROGRAMMES = (species.BIRD_PROGRAMME + " 2", "Hundivaatlused", "Karuvaatlused 1", soil_water.SOIL_PROGRAMME, air.PROGRAMME_PREFIX + " jaam", "muu")
SPECIES = (*species.PREDATORS, "rebane")
NAMES = (soil_water.NO3, soil_water.NO3N, *soil_water.NUTRIENTS, "pH", "Vask", "Benseen")
UNITS = ("mg/l", "mgN/l", "µg/l", "mg/m³", "mg/kg KA")
TYPES = ("V1", "S2", "R", "X")


def _sql_list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


MEASURED_SQL = f"""
m AS (SELECT {_sql_list(PROGRAMMES)}[l_partkey % 6 + 1] AS programme, CASE WHEN l_linenumber <> 7 THEN {_sql_list(SPECIES)}[l_suppkey % 4 + 1] END AS liik, 'p' || l_suppkey AS place,
       l_quantity - 5 AS v, CASE WHEN l_linenumber <> 6 THEN CAST(year(l_shipdate) AS INTEGER) + 15 END AS year, {_sql_list(NAMES)}[l_partkey % 7 + 1] AS name, {_sql_list(UNITS)}[l_suppkey % 5 + 1] AS unit,
       l_returnflag AS flag, {_sql_list(TYPES)}[l_linenumber % 4 + 1] AS kind, l_linestatus = 'O' AS ground FROM lineitem)"""


def measurements(spark, sf) -> DataFrame:
    """The long table of measurements: every line is one."""

    def of(names, number: str):
        return F.element_at(F.array(*map(F.lit, names)), (F.col(number) % len(names) + 1).cast("int"))

    day = F.concat((F.year("l_shipdate") + 15).cast("string"), F.lit("-05-01"))
    return table(spark, sf, "lineitem").select(
        of(PROGRAMMES, "l_partkey").alias("seiretoo_nimetus"),
        F.when(F.col("l_linenumber") != 7, of(SPECIES, "l_suppkey")).alias("liik_est"),
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("seirekoht_kood"),
        (F.col("l_quantity") - 5).alias("vaartus_arv_moodetud"),
        F.when(F.col("l_linenumber") != 6, day).otherwise("x").alias("seireaeg_algus"),
        of(NAMES, "l_partkey").alias("naitaja_nimetus"),
        of(UNITS, "l_suppkey").alias("naitaja_abr_unit"),
        F.when(F.col("l_returnflag") == "R", soil_water.SOIL_MATRIX).otherwise("vesi").alias("naitaja_proovimaatriks_nimi"),
        F.when(F.col("l_returnflag") != "A", air.GROUP).alias("naitaja_grupp_selg"),
        of(TYPES, "l_linenumber").alias("seirekogum_tyyp"),
        F.when(F.col("l_linestatus") == "O", "g").alias("pohjaveekogum_kood"),
        F.when(F.col("l_tax") > 0.05, "<").alias("vaartus_erimark"),
    )


def _effort(rows: DataFrame, keys: list[str], present: bool) -> DataFrame:
    return species.effort(rows.where(F.lit(present)), keys, "seirekoht_kood")


@query(
    "bird_effort",
    "N01 N02",
    f"""WITH {MEASURED_SQL} SELECT liik AS liik_est, year, count(DISTINCT place) AS districts, count(*) AS observations FROM m
WHERE starts_with(programme, '{species.BIRD_PROGRAMME}') AND v >= 0 AND liik IS NOT NULL AND year >= {species.BIRD_FIRST_YEAR} GROUP BY 1, 2""",
)
def bird_effort(spark, sf):
    m = measurements(spark, sf)
    return _effort(species.prepare_birds(m), ["liik_est", "year"], species.has_birds(m))


@query(
    "predator_effort",
    "N08 N09",
    f"""WITH {MEASURED_SQL} SELECT liik AS liik_est, year, count(DISTINCT place) AS districts, count(*) AS observations FROM m
WHERE programme IN ('Hundivaatlused', 'Karuvaatlused 1') AND v >= 0 AND liik <> 'rebane' AND year >= {species.PREDATOR_FIRST_YEAR} GROUP BY 1, 2""",
)
def predator_effort(spark, sf):
    m = measurements(spark, sf)
    return _effort(species.prepare_predators(m), ["liik_est", "year"], species.has_predators(m))


@query(
    "air_effort",
    "Q01",
    f"""WITH {MEASURED_SQL} SELECT name AS naitaja_nimetus, CAST(year AS VARCHAR) AS year, count(DISTINCT place) AS districts, count(*) AS observations FROM m
WHERE starts_with(programme, '{air.PROGRAMME_PREFIX}') AND flag <> 'A' AND name = 'Benseen' GROUP BY 1, 2""",
)
def air_effort(spark, sf):
    m = measurements(spark, sf)
    return _effort(air.prepare(m), ["naitaja_nimetus", "year"], air.has_air(m)).withColumn("year", F.col("year").cast("string"))


@query(
    "soil_periods",
    "N19",
    f"""WITH {MEASURED_SQL}, s AS (SELECT *, (year - {soil_water.SOIL_FIRST_YEAR}) // {soil_water.SOIL_PERIOD} * {soil_water.SOIL_PERIOD} + {soil_water.SOIL_FIRST_YEAR} AS y FROM m
WHERE programme = '{soil_water.SOIL_PROGRAMME}' AND flag = 'R' AND name IN ('pH', 'Vask') AND year >= {soil_water.SOIL_FIRST_YEAR})
SELECT name AS naitaja_nimetus, y || '-' || (y + {soil_water.SOIL_PERIOD - 1}) AS period, count(DISTINCT place) AS districts, count(*) AS observations FROM s GROUP BY 1, 2""",
)
def soil_periods(spark, sf):
    return species.effort(soil_water.prepare_soil(measurements(spark, sf)), ["naitaja_nimetus", "period"], "seirekoht_kood")


CATEGORY_SQL = "CASE kind " + " ".join(f"WHEN '{t}' THEN '{soil_water.CATEGORIES[t[0]]}'" for t in TYPES[:3]) + " END"


@query(
    "water_categories",
    "W01 W02",
    f"WITH {MEASURED_SQL} SELECT {CATEGORY_SQL} AS category, ground AS groundwater, CAST(year AS VARCHAR) AS year, count(*) AS n FROM m GROUP BY 1, 2, 3",
)
def water_categories(spark, sf):
    return soil_water.prepare_water(measurements(spark, sf)).groupBy("category", "groundwater", F.col("year").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "water_document",
    "W07",
    f"""WITH {MEASURED_SQL}, n AS (SELECT *, (v >= 0 AND ((name = '{soil_water.NO3N}' AND unit IN ('mg/l', 'mgN/l')) OR (name = '{soil_water.NO3}' AND unit = 'mg/l'))) AS ok FROM m
WHERE ground AND name IN ('{soil_water.NO3}', '{soil_water.NO3N}'))
SELECT 'rows_used' AS part, CAST(NULL AS VARCHAR) AS key, count(*) FILTER (ok) AS n FROM n UNION ALL SELECT 'rows_excluded', NULL, count(*) FILTER (NOT ok) FROM n
UNION ALL SELECT 'units', unit, count(*) FROM m GROUP BY 2 UNION ALL SELECT 'categories', {CATEGORY_SQL}, count(*) FROM m GROUP BY 2
UNION ALL SELECT 'samples', CAST(year AS VARCHAR), count(*) FROM n WHERE ok GROUP BY 2 UNION ALL SELECT 'sites', CAST(year AS VARCHAR), count(DISTINCT place) FROM n WHERE ok GROUP BY 2""",
)
def water_document(spark, sf):
    parts = soil_water.build_water(measurements(spark, sf))
    rows = parts["nitrate_rows"]
    found = [rows.select(F.lit(c).alias("part"), F.lit(None).cast("string").alias("key"), F.col(c).alias("n")) for c in rows.columns]
    found += [parts[p].select(F.lit(p).alias("part"), F.col(k).alias("key"), F.col("rows").alias("n")) for p, k in (("units", "naitaja_abr_unit"), ("categories", "category"))]
    nitrate = parts["groundwater_nitrate"]
    found += [nitrate.select(F.lit(c).alias("part"), F.col("year").cast("string").alias("key"), F.col(c).alias("n")) for c in ("samples", "sites")]
    return reduce(DataFrame.unionByName, found)


@query(
    "waste_clean",
    "T01",
    """WITH s AS (SELECT CASE WHEN l_linenumber <> 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS aasta, nullif(l_returnflag, 'A') AS maht_liik, sum(l_quantity) AS maht,
sum(CASE WHEN l_discount > 0.05 AND l_linestatus = 'O' THEN -l_quantity END) AS neg_sum FROM lineitem GROUP BY 1, 2)
SELECT aasta, maht_liik, round(maht, 6) AS maht, round(coalesce(neg_sum, 0), 6) AS neg_sum FROM s WHERE aasta IS NOT NULL AND maht_liik IS NOT NULL""",
)
def waste_clean(spark, sf):
    li = table(spark, sf, "lineitem")
    year = F.when(F.col("l_linenumber") != 7, F.year("l_shipdate").cast("string")).alias("aasta")
    negative = F.when((F.col("l_discount") > 0.05) & (F.col("l_linestatus") == "O"), -F.col("l_quantity"))
    stored = li.groupBy(year, F.nullif("l_returnflag", F.lit("A")).alias("maht_liik")).agg(F.sum("l_quantity").alias("maht"), F.sum(negative).alias("neg_sum"))
    return rounded(waste.clean(stored))


@query(
    "registration_years",
    "K08",
    """SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS VARCHAR) END AS year, count(*) AS n FROM orders GROUP BY 1""",
)
def registration_years(spark, sf):
    date = F.date_format("o_orderdate", "dd.MM.yyyy")
    text = F.concat("o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" nr 18: "), date, F.lit(" (3)"))).otherwise(" ..19.1."))
    return table(spark, sf, "orders").groupBy(registration_year(text).cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cube_slices",
    "X11 X15 X20 X22",
    """WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS s, o_orderpriority AS p, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2, 3)
SELECT 'F urgent' AS slice, year, v AS value FROM c WHERE s = 'F' AND p = '1-URGENT' UNION ALL SELECT 'O low', year, v FROM c WHERE s = 'O' AND p = '5-LOW'
UNION ALL SELECT 'all high', year, round(sum(v), 2) FROM c WHERE p = '2-HIGH' GROUP BY 2""",
)
def cube_slices(spark, sf):
    year, nbsp = F.year("o_orderdate").cast("string"), " "
    cells = table(spark, sf, "orders").groupBy(year.alias("Aasta"), F.col("o_orderstatus").alias(f"order{nbsp}status"), F.col("o_orderpriority").alias(f"order{nbsp}rank")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    cube = cubes.clean_names(cells)
    slices = {"F urgent": {"order status": "F", "order rank": "1-URGENT"}, "O low": {"order status": "O", "order rank": "5-LOW"}, "all high": {"order rank": "2-HIGH"}}
    rows = reduce(DataFrame.unionByName, [cubes.slice_series(cube, where, "Aasta").withColumn("slice", F.lit(name)) for name, where in slices.items()])
    return rows.groupBy("slice", "year").agg(F.round(F.sum("value"), 2).alias("value"))


@query("landed_or_empty", "S11", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def landed_or_empty(spark, sf):
    schema, wanted = "c_custkey bigint, c_mktsegment string", F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    landed = read_or_empty(spark, f"{sf}/customer.parquet", schema, "parquet", wanted)
    return landed.unionByName(read_or_empty(spark, None, schema))
