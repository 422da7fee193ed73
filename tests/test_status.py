import pytest
from pyspark.sql import functions as F

from tidemark.operators import composition as comp
from tidemark.operators import linkage as lk
from tidemark.operators import transition as tr
from tidemark.plans import water

REGISTER = "id bigint, veekogu_tyyp string, keht_staatus string"
STATES = "vkm_id bigint, aasta string, tyyp string, seis string, keht_staatus string, muut_aeg string, staatus string"


@pytest.fixture(scope="module")
def register(spark):
    return spark.createDataFrame([(1, "11", "Kehtiv"), (2, "21", "Kehtiv"), (3, "30", "Kehtiv"), (4, "12", "Kehtetu"), (5, None, "Kehtiv")], REGISTER)


@pytest.fixture(scope="module")
def states(spark):
    data = [
        (1, "2015", "S", "3", "Kehtiv", "2016-01-01", None),
        (1, "2015", "S", "5", "Kehtiv", "2015-01-01", None),  # older duplicate loses
        (1, "2019", "S", "4", "Kehtiv", "2019-01-01", None),
        (1, "2021", "S", "2", "Kehtiv", None, None),
        (2, "2015", "S", "2", "Kehtiv", "x", None),
        (2, "2018", "S", "2", "Kehtiv", "x", None),
        (3, "2015", "S", "1", "Kehtiv", "x", None),
        (3, "2018", "S", "3", "Kehtiv", "x", None),
        (3, "2020", "S", "1", "Kehtetu", "x", None),  # invalid row ignored
        (5, "2015", "S", "U", "Kehtiv", "x", None),
        (1, "2015", "E", None, "Kehtiv", "x", "saavutatud"),
        (2, "2015", "E", None, "Kehtiv", "x", "saavutamata"),
        (3, "2015", "E", None, "Kehtiv", "x", None),
    ]
    return spark.createDataFrame(data, STATES)


def test_status_sections(spark, register, states, rows):
    load = spark.createDataFrame(
        [
            (1, "Oluline", "A", "x", "Survetegur on aktuaalne"),
            (1, "Oluline", "B", None, "Survetegur on aktuaalne"),
            (2, "Väheoluline", "A", "x", "Survetegur on aktuaalne"),
            (4, "Oluline", "A", "x", "Survetegur on aktuaalne"),
        ],
        "koormus_veekogum_id bigint, olulisus_selg string, pohjus_selg string, hinnang_moju_selg string, koormus_staatus_selg string",
    )
    gw = spark.createDataFrame(
        [(2014, 1, "1", "1", "1"), (2014, 2, "2", "1", "3"), (2020, 1, "1", "2", "1"), (2020, 2, "1", "1", "1")],
        "aasta int, pohjaveekogum_id bigint, seis string, seis_kem string, seis_kog string",
    )
    out = water.build_status(register, states, load, gw)
    base = out["baseline"].first()
    assert (base["n"], base["classified"], base["not_classified"]) == (4, 3, 1) and base["share_good"] == pytest.approx(2 / 3)
    paired = {r["group"]: r for r in out["paired"].collect()}
    assert (paired[None]["improved"], paired[None]["same"], paired[None]["worsened"]) == (1, 1, 1)
    assert paired["Vooluveekogu"]["improved"] == 1 and paired["Meri"]["worsened"] == 1
    m = {r["cls0"]: r for r in out["matrix"].collect()}
    assert len(m) == 5 and m["3"]["to_2"] == 1 and m["1"]["to_3"] == 1 and m["4"]["to_4"] == 0
    t = out["targets"].first()
    assert (t["objective_rows"], t["flagged"], t["achieved"], t["not_achieved"]) == (3, 2, 1, 1)
    total = out["pressures_total"].first()
    assert (total["assessed"], total["with_condition"]) == (2, 1)
    assert {r["name"]: r["bodies"] for r in out["pressures_by_sector"].collect()} == {"A": 1, "B": 1}
    groups = {r["group"]: (r["assessed"], r["with_condition"]) for r in out["pressures_by_group"].collect()}
    assert groups == {"Vooluveekogu": (1, 1), "Järv": (1, 0), "Meri": (0, 0)}
    years = {(r["aasta"], r["status"]): r for r in out["groundwater_years"].collect()}
    assert years[(2014, "seis")]["class_2"] == 1 and years[(2020, "seis_kem")]["class_2"] == 1
    gwp = out["groundwater_paired"].first()
    assert (gwp["from"], gwp["to"], gwp["n"], gwp["improved"], gwp["same"]) == (2014, 2020, 2, 1, 1)


def test_balance(spark):
    gw = spark.createDataFrame(
        [(2023, "pv1", 3650.0), (2024, " Pv1 ", 7300.0), (2024, "PV2", 365.0), (2024, "PV3", 730.0), (2024, "PV9", 10.0), (2024, "PV1", None)],
        "aruandeaasta int, veehaardekood string, aastakokku double",
    )
    intakes = spark.createDataFrame([(1, "PV1", "joogivesi"), (2, "PV2", None), (3, "PV3", "muu"), (4, "PV4", "muu")], "id bigint, kkr_kood string, veeliik_selg string")
    bores = spark.createDataFrame(
        [(1, 10, "Kehtiv"), (1, 10, "Kehtiv"), (2, 20, "Kehtiv"), (3, 10, "Kehtiv"), (3, 20, "Kehtiv"), (4, 30, "Kehtetu")],
        "veehaare_id bigint, pohjaveekogum_id bigint, keht_staatus string",
    )
    res = spark.createDataFrame([(10, "Kehtiv", 10), (10, "Kehtetu", 1000), (30, "Kehtiv", 5)], "pohjaveekogum_id bigint, keht_staatus string, varu_t1_olme bigint")
    st = spark.createDataFrame([(10, 2014, "a", "K10", "2"), (10, 2020, None, "K10", "1"), (20, 2020, "b", "K20", "3")], "pohjaveekogum_id bigint, aasta int, muut_aeg string, kood string, seis_kog string")
    out = water.build_balance(gw, intakes, bores, res, st)
    a = {r["aruandeaasta"]: r for r in out["allocation"].collect()}
    assert a[2024]["total"] == 8405.0 and a[2024]["rows"] == 4
    assert a[2024]["single"] == pytest.approx(7665 / 8405) and a[2024]["multiple"] == pytest.approx(730 / 8405) and a[2024]["none"] == pytest.approx(10 / 8405)
    body = out["bodies"].first()
    assert body["kood"] == "K10" and body["ratio"] == pytest.approx(2.0) and body["seis_kog"] == "1" and body["deposits"] == 1
    s = out["summary"].first()
    assert (s["units_with_amount"], s["units_with_reserve"], s["units_with_both"], s["ratio_gt1"]) == (2, 2, 1, 1)
    assert s["per_day_without_reserve"] == pytest.approx(1.0)
    kinds = {r["kind"]: (r["total"], r["total_single"]) for r in out["intake_types"].collect()}
    assert kinds == {"joogivesi": (7300.0, 7300.0), "muu": (730.0, 0.0), "Märkimata": (375.0, 365.0)}


def test_link_reports(spark):
    gw = spark.createDataFrame([(" a1", "x", 10.0), ("A2 ", None, 30.0), ("A3", None, 60.0)], "veehaardekood string, jaamakood string, aastakokku double")
    res = spark.createDataFrame([("A1", None), ("a2", None), ("Q", None)], "kood string, kkr_kood string")
    got = {(r["left_column"], r["right_column"]): r for r in lk.link_report(gw, res, ["veehaardekood", "jaamakood"], ["kood", "kkr_kood", "zz"], "aastakokku").collect()}
    r = got[("veehaardekood", "kood")]
    assert (r["distinct_left"], r["distinct_right"], r["matching_codes"]) == (3, 3, 2) and r["matching_volume_share"] == pytest.approx(0.4)
    assert got[("veehaardekood", "kkr_kood")]["matching_codes"] == 0 and len(got) == 4


def test_water_use(spark):
    use = spark.createDataFrame(
        [(1, 2023, "p", "põhjavesi", 10.0, 4.0, 6.0), (2, 2023, "p", None, 5.0, 1.0, 1.0), (2, 2023, "p", None, 5.0, 5.0, None)],
        "annual_report_id bigint, aruandeaasta int, kasutuspiirkond string, veeliik string, kokku double, olme double, toostus double",
    )
    for c in ("jahutus", "energeetika", "pollumajandus", "niisutus", "muu", "veekadu"):
        use = use.withColumn(c, F.lit(None).cast("double"))
    months = [F.lit(1.0).alias(m) for m in water.MONTHS]
    gw = spark.createDataFrame([(1, 2023, 12.0)], "annual_report_id bigint, aruandeaasta int, aastakokku double").select("*", *months)
    dis = spark.createDataFrame(
        [(2023, "v1", 100.0, "Arvutuslik", 5.0, 1.0, 2.0, 3.0, 9.0), (2023, "v2", 50.0, "Mõõdetud", None, 9.0, 9.0, 9.0, 9.0), (2023, "v3", 1.0, "Mõõdetud", 5.0, 1.0, None, 2.0, 3.0)],
        "aruandeaasta int, valjalaskmekood string, heitveehulkaastas double, arvutusviis string, bht7kontsentratsioonlubatud double, bht7kontsentratsioon1kv double, bht7kontsentratsioon2kv double, bht7kontsentratsioon3kv double, bht7kontsentratsioon4kv double",
    )
    res = spark.createDataFrame([("Q", "Kehtiv", 5), ("", "Kehtiv", 50), ("D", "Kehtiv", 9), ("D", "Kehtetu", 90)], "geol_indeks string, keht_staatus string, varu_t1_olme bigint")
    ra = spark.createDataFrame([("väike", "Kehtiv", 10, 20, 1.5), ("suur", "Kehtiv", 30, 40, 2.0), ("suur", "Kehtetu", 1, 1, 1.0)], "tyyp_selg string, keht_staatus string, elanikke int, koormus int, pindala double")
    out = water.build_use(use, gw, gw.limit(0), dis, res, ra)
    kinds = {r["veeliik"]: (r["m3"], r["reports"], r["rows"]) for r in out["use_by_type"].collect()}
    assert kinds == {"põhjavesi": (10.0, 1, 1), "määramata": (10.0, 1, 2)}
    s = out["use_by_sector"].first()
    assert (s["kokku"], s["olme"], s["toostus"], s["jahutus"], s["sectors_sum"]) == (20.0, 10.0, 7.0, 0.0, 17.0)
    t = out["tiling"].first()
    assert (t["rows"], t["within_tolerance"]) == (3, 2)
    assert out["duplicates"].first()["groups_with_multiple_rows"] == 1
    assert sum(r["m3"] for r in out["monthly_groundwater"].collect()) == 12.0
    c = out["compliance"].first()
    assert (c["substance"], c["with_limit"], c["over_limit"]) == ("bht7", 2, 1)
    assert [r["geol_indeks"] for r in out["reserves"].collect()] == ["D", "Q"]
    total = out["agglomerations"].where("tyyp_selg is null").first()
    assert (total["n"], total["residents"]) == (2, 40)
    assert out["abstraction_vs_use"].first()["ratio"] == pytest.approx(0.6)


def test_paired_ends_gates(spark):
    data = [("i", s, y, 20.0 if y < 2013 else 10.0) for s in ("a", "b", "c") for y in range(2010, 2016)]
    df = spark.createDataFrame(data, "k string, s string, y int, v double")
    r = tr.paired_ends(df, ["k"], "s", "y", "v").first()
    assert (r["stations"], r["median_change_pct"], r["share_decreased"]) == (3, pytest.approx(-50.0), 1.0)
    assert (r["first_from"], r["first_to"], r["last_from"], r["last_to"]) == (2010, 2012, 2013, 2015)
    assert tr.paired_ends(df.where("y < 2015"), ["k"], "s", "y", "v").count() == 0
    assert tr.paired_ends(df.where("s < 'c'"), ["k"], "s", "y", "v").count() == 0


def test_null_member_among_the_largest(spark):
    df = spark.createDataFrame([(1, None, 9.0), (1, "a", 5.0), (2, None, 1.0), (2, "b", 2.0), (2, "c", 1.0)], "y int, m string, v double")
    got = {(r["y"], r["m"]): r["total"] for r in comp.fold_rest(df, ["y"], "m", "v", 2).collect()}
    assert got == {(1, None): 9.0, (1, "a"): 5.0, (2, None): 1.0, (2, "other"): 3.0}
    named = {(r["y"], r["m"]): r["total"] for r in comp.fold_rest(df, ["y"], "m", "v", 1, missing="unknown").collect()}
    assert named == {(1, "unknown"): 9.0, (1, "other"): 5.0, (2, "unknown"): 1.0, (2, "other"): 3.0}
