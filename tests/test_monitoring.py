import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import mergeable as mg
from tidemark.plans import air, monitoring, soil_water, species


def test_air_quality(spark):
    base = ("Saasteained välisõhus", "Välisõhu kvaliteedi seire 2019. a", "Peened osakesed (PM 10)")
    data = []
    for y in range(2014, 2020):
        for d in range(365):
            for s in ("A", "B", "C"):
                v = 60.0 if (s == "A" and y == 2019 and d < 40) else (20.0 if y < 2017 else 10.0)
                data.append((*base, v, "µg/m³", f"{y}-{d // 31 + 1:02d}-{d % 31 + 1:02d}T00:00:00", s, "<" if d < 73 else None))
    data += [(*base, 5.0, "ppbv", "2019-01-01", "A", None), (*base, -999.0, "µg/m³", "2019-01-01", "A", None)]
    df = spark.createDataFrame(
        data,
        "naitaja_grupp_selg string, seiretoo_nimetus string, naitaja_nimetus string, vaartus_arv_moodetud double, naitaja_abr_unit string, seireaeg_algus string, seirekoht_kood string, vaartus_erimark string",
    )
    assert air.has_air(df) and not air.has_air(df.drop("seirekoht_kood")) and not species.has_birds(df)
    out = air.build(df)
    years = {r["year"]: r for r in out["years"].collect()}
    assert len(years) == 6 and years[2014]["stations"] == 3 and years[2014]["median"] == pytest.approx(20.0)
    assert years[2019]["over_max"] == 40 and years[2019]["stations_above_allowed"] == 1
    assert years[2014]["loq_share"] == pytest.approx(0.2)
    p = out["paired"].first()
    assert p["stations"] == 3 and p["median_change_pct"] == pytest.approx(-50.0)
    left = out["left_out"].first()
    assert (left["other_unit"], left["negative_or_sentinel"]) == (1, 1)
    assert [r["programme"] for r in out["programmes"].collect()] == ["Välisõhu kvaliteedi seire"]
    assert out["levels"].first()["limit"] == 40.0


def test_bird_index(spark):
    data = []
    for y in range(2010, 2013):
        for p in range(60):
            for v in (16.0 / 2 ** (y - 2010), 1.0):
                data.append(("Haudelinnustiku punktloendused 2010", "A", f"P{p}", f"{y}-05-01", v))
            data.append(("Haudelinnustiku punktloendused 2010", "B", f"P{p}", f"{y}-05-01", 2.0))
            data.append(("Haudelinnustiku punktloendused 2010", "E", f"P{p}", f"{y}-05-01", 1.0 * 20 ** (y - 2010)))
        data.append(("Muu programm", "A", "P1", f"{y}-05-01", 99.0))
    data.append(("Haudelinnustiku punktloendused 2010", "R", "P1", "2010-05-01", 1.0))
    df = spark.createDataFrame(data, "seiretoo_nimetus string, liik_est string, seirekoht_kood string, seireaeg_algus string, vaartus_arv_moodetud double")
    assert species.has_birds(df)
    out = species.build_birds(df, reps=20)
    sp = {r["species"]: r for r in out["species"].collect()}
    assert set(sp) == {"A", "B", "E"}
    assert sp["A"]["last"] == pytest.approx(25.0) and sp["B"]["last"] == pytest.approx(100.0) and sp["E"]["extreme"]
    comp = {r["year"]: r for r in out["composite"].collect()}
    assert comp[2012]["index"] == pytest.approx(50.0) and comp[2012]["species_used"] == 2
    assert comp[2012]["lo"] == pytest.approx(50.0) and comp[2010]["index"] == pytest.approx(100.0)
    assert {r["points"] for r in out["points_per_link"].collect()} == {60}
    assert {r["year"]: r["points"] for r in out["points_per_year"].collect()} == {2010: 60, 2011: 60, 2012: 60}


def test_implied_zeros_break_a_chain(spark):
    from tidemark.operators import chain_index as ci

    data = [("A", f"P{p}", 2000, 5.0) for p in range(4)] + [("B", f"P{p}", y, 5.0) for p in range(4) for y in (2000, 2001, 2002)]
    df = spark.createDataFrame(data, "s string, p string, year int, v double")
    out = ci.chained_index(df, "s", "p", "year", "v", 1.0, 2, reps=0)
    assert [r["species"] for r in out["species"].collect()] == ["B"]
    cube = ci.visit_maximum(df, "s", "p", "year", "v")
    got = {(r["species"], r["step"]): (r["base"], r["ratio"]) for r in ci.links(cube, ci.surveyed_links(cube), None, 1.0, 2).collect()}
    assert got[("A", 1)] == (20.0, None) and got[("B", 2)] == (20.0, 1.0)


def test_predators_and_crowns(spark):
    data = [("Hundivaatlused jahipiirkondades", "hunt", f"J{d}", f"{y}-01-01", 1.0, "Liigi isendite arv") for d in range(25) for y in range(2004, 2012)]
    data += [("Hundivaatlused jahipiirkondades", "rebane", "J1", "2010-01-01", 1.0, "Liigi isendite arv"), ("Muud hundivaatlused", "hunt", "J1", "2010-01-01", 1.0, "x")]
    df = spark.createDataFrame(data, "seiretoo_nimetus string, liik_est string, seirekoht_kood string, seireaeg_algus string, vaartus_arv_moodetud double, naitaja_nimetus string")
    assert species.has_predators(df)
    out = species.build_predators(df)
    got = {r["year"]: (r["districts"], r["observations"]) for r in out["effort"].collect()}
    assert set(got) == set(range(2006, 2012)) and got[2006] == (25, 25)
    assert out["by_indicator"].first()["rows"] == 150

    ind = species.CROWN_INDICATOR
    crown = spark.createDataFrame(
        [
            (ind, "2020-07-01", "P1", "1", "harilik mänd", ">20-25%"),
            (ind, "2020-07-01", "P1", "1", "harilik mänd", "0 %, ei ole"),
            (ind, "2020-07-01", "P2", None, "harilik kuusk", ">60-65%"),
            (ind, "2020-07-01", "P2", "3", "harilik kuusk", "Hindamata"),
            ("muu", "2020-07-01", "P2", "4", "harilik kuusk", ">60-65%"),
        ],
        "naitaja_nimetus string, seireaeg_algus string, seirekoht_kood string, isend_nr string, liik_est string, vaartus_muu string",
    )
    out = species.build_crowns(crown)
    total = out["by_year"].where("all_species = 1").first()
    assert (total["trees"], total["plots"], total["none"], total["slight"], total["severe"]) == (3, 2, 1, 1, 1)
    assert total["share_damaged"] == pytest.approx(1 / 3) and total["mean_upper"] == pytest.approx(30.0)
    assert out["check_duplicates"].first()["groups_with_multiple_rows"] == 1
    assert out["check_rows"].first()["not_assessed_or_unparsed"] == 1


def test_soil(spark):
    rnd = random.Random(2)
    base = ("Mullaseire 2003", "Muld, pinnas")
    data = []
    for p in range(25):
        data.append((*base, "pH", 6.0, "", "2003-05-01", f"P{p}", None))
        data.append((*base, "pH", 5.5, "", "2013-05-01", f"P{p}", "<"))
    data += [(*base, "pH", 42921.0, "", "2003-05-01", "P1", None), (*base, "pH", 6.0, "", "1999-05-01", "P1", None)]
    data += [(*base, "Plii", 10.0 + rnd.random() * 0, u, "2003-05-01", "P1", None) for u in ("mg/kg KA", "µg/kg KA", "tundmatu")]
    data += [(*base, "Huumussisaldus", 3.0, "% KA", "2003-05-01", "P1", None)]
    df = spark.createDataFrame(
        data,
        "seiretoo_nimetus string, naitaja_proovimaatriks_nimi string, naitaja_nimetus string, vaartus_arv_moodetud double, naitaja_abr_unit string, seireaeg_algus string, seirekoht_kood string, vaartus_erimark string",
    )
    out = soil_water.build_soil(df)
    per = {(r["naitaja_nimetus"], r["period"]): r for r in out["periods"].collect()}
    assert per[("pH", "2002-2006")]["median"] == 6.0 and per[("pH", "2012-2016")]["below_loq_mark"] == 25
    assert per[("Plii", "2002-2006")]["samples"] == 2 and per[("Plii", "2002-2006")]["p10"] == pytest.approx(0.01)
    assert per[("Huumussisaldus", "2002-2006")]["median"] == pytest.approx(3.0)
    p = out["paired"].first()
    assert (p["from"], p["to"], p["plots"]) == ("2002-2006", "2012-2016", 25) and p["median_change"] == pytest.approx(-0.5)
    assert "methods" not in out


def test_water_quality(spark):
    n3, n3n = soil_water.NO3, soil_water.NO3N
    data = [(n3, "mg/l", v, "2020-01-01", s, "G", None, m) for v, s, m in ((10.0, "a", None), (60.0, "b", "<"), (22.0, "c", None))]
    data += [(n3n, "mgN/l", 2.0, "2020-02-01", "a", "G", None, None), (n3n, "mg/l", 100.0, "2020-02-01", "d", "G", None, None)]
    data += [(n3, "mmol/l", 1.0, "2020-01-01", "a", "G", None, None), (n3, "mg/l", -1.0, "2020-01-01", "a", "G", None, None)]
    data += [("Üldlämmastik", "µmolN/l", 100.0, "2020-01-01", f"r{i}", None, "R1", None) for i in range(5)]
    data += [("Üldfosfor", "µmolN/l", 1.0, "2020-01-01", "z", None, "V1", None)]
    df = spark.createDataFrame(
        data,
        "naitaja_nimetus string, naitaja_abr_unit string, vaartus_arv_moodetud double, seireaeg_algus string, seirekoht_kood string, pohjaveekogum_kood string, seirekogum_tyyp string, vaartus_erimark string",
    )
    out = soil_water.build_water(df)
    r = out["groundwater_nitrate"].first()
    assert (r["samples"], r["sites"]) == (5, 4) and r["median"] == pytest.approx(22.0)
    assert r["share_over_limit"] == pytest.approx(0.4) and r["site_share_over_limit"] == pytest.approx(0.5)
    n = out["nitrate_rows"].first()
    assert (n["rows_used"], n["rows_excluded"]) == (5, 2)
    s = out["surface"].first()
    assert (s["nutrient"], s["category"], s["sites"]) == ("tn", "Rannikuvesi", 5) and s["median"] == pytest.approx(1.4007)


def test_catalogue(spark):
    keys = [monitoring.PROGRAMME, monitoring.GROUP, monitoring.CODE, monitoring.NAME, monitoring.UNIT, monitoring.SPECIES, "year"]
    data = [("P", "G", "c", "Liigi arvukus", u, s, y, v) for u, s, y, v in (("tk", "A", 2019, 1.0), ("tk", "B", 2019, -2.0), (None, None, 2020, 5.0), ("kg", "A", 1980, None))]
    df = spark.createDataFrame(data, ", ".join(f"`{k}` {'int' if k == 'year' else 'string'}" for k in keys) + ", v double")
    parts = [mg.partial_range(df.where("year < 2019"), keys, "v"), mg.partial_range(df.where("year >= 2019"), keys, "v")]
    merged = mg.merge_range(parts, keys)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, mg.partial_range(df, keys, "v").collect()), key=str)
    cat = monitoring.catalogue(merged)
    r = cat["indicators"].first()
    assert (r["rows"], r["n_value"], r["units"], r["species"], r["years"], r["negatives"]) == (4, 3, ["kg", "tk"], 3, 3, 1)
    assert cat["programmes"].first()["species"] == 3
    cov = monitoring.coverage(cat)
    assert {r["year"] for r in cov["rows_by_year"].collect()} == {2019, 2020}
    assert cov["groups"].first()["years"] == 3


def test_sections_follow_the_data(spark):
    cols = "naitaja_nimetus string, seireaeg_algus string, seirekoht_kood string, isend_nr string, liik_est string, vaartus_muu string"
    crown = spark.createDataFrame([(species.CROWN_INDICATOR, "2020-07-01", "P1", "1", "harilik mänd", ">20-25%")], cols)
    out = monitoring.build(crown)
    assert {k.split(".")[0] for k in out} == {"crowns"} and out["crowns.by_year"].count() == 2
