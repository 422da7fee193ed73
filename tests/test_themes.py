import pytest
from pyspark.sql import functions as F

from tidemark.plans import air_energy, forest, nature, official, waste


def test_waste(spark):
    cols = "aasta int, maht_liik string, pohigrupp string, jaatmeliik string, jaatmeliik_nimi string, pohigrupp_nimi string, ohtlik_lipp string, biojaatmed_lipp string, partner_riik_nimi string, maht double"
    g, e, s0, s1 = waste.GENERATION, waste.EXPORT, waste.STOCK_START, waste.STOCK_END
    data = [
        (2020, g, "20", "20 01 01", "paber", "Olme", "Ei", "Jah", None, 100.0),
        (2020, g, "20", "20 01 01", "paber", "Olme", "Ei", "Jah", None, -10.0),
        (2020, g, "15", "15 01 02", "plast", "Pakend", "Jah", "Ei", None, 30.0),
        (2021, g, "15", "15 01 02", "plast", "Pakendid", "Jah", "Ei", None, 50.0),
        (2020, s1, "20", "x", "x", None, "Ei", "Ei", None, 50.0),
        (2021, s0, "20", "x", "x", None, "Ei", "Ei", None, 45.0),
        (2021, e, "15", "15 01 02", "plast", "Pakend", "Ei", "Ei", "Läti", 7.0),
        (2021, e, "15", "15 01 02", "plast", "Pakend", "Ei", "Ei", "Soome", 9.0),
        (None, g, "15", "15 01 02", "plast", "Pakend", "Ei", "Ei", None, 1.0),
    ]
    raw = spark.createDataFrame(data, cols)
    for c in waste.WASTE_KEYS:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    agg = waste.combine(waste.aggregate(raw.where("aasta = 2020 or aasta is null")), waste.aggregate(raw.where("aasta = 2021")))
    out = waste.build(agg)
    flows = {(r["aasta"], r["maht_liik"]): r for r in out["flows"].collect()}
    r = flows[(2020, g)]
    assert (r["total"], r["negative_total"], r["rows"], r["negative_rows"]) == (120.0, -10.0, 3, 1)
    hz = {r["aasta"]: r["share"] for r in out["hazardous_generation"].collect()}
    assert hz[2020] == pytest.approx(0.25) and hz[2021] == 1.0
    st = out["stock_continuity"].first()
    assert (st["aasta"], st["closing"], st["next_opening"]) == (2020, 50.0, 45.0) and st["ratio"] == pytest.approx(0.9)
    assert {r["pohigrupp"]: r["pohigrupp_nimi"] for r in out["chapter_names"].collect()} == {"20": "Olme", "15": "Pakendid"}
    streams = {(r["stream"], r["maht_liik"], r["aasta"]): r["tonnes"] for r in out["stream_flows"].collect()}
    assert streams[("municipal", g, 2020)] == 90.0 == streams[("bio", g, 2020)] and streams[("packaging", g, 2021)] == 50.0
    assert {r["partner_riik_nimi"] for r in out["export_partners"].collect()} == {"Läti", "Soome"}
    assert out["top_generation"].first()["jaatmeliik"] == "15 01 02"
    flags = {(r["flag"], r["value"]): r["rows"] for r in out["flag_values"].collect()}
    assert flags[("ohtlik_lipp", "Jah")] == 2
    grain = waste.grain(raw)
    assert grain["duplicates"].first()["groups_with_different_values"] == 1
    assert grain["quantiles"].first()["p100"] == 100.0


def test_nature(spark):
    areas = spark.createDataFrame([("kaitsealune ala", "looduskaitseala", 10.0, None), ("kaitsealune", None, None, 2.0), ("projekteeritav", "park", 5.0, 0.0)], "al_staatus_selg string, tyyp_selg string, pindala_maa double, pindala_meri double").withColumn("iucn_tyyp_selg", F.lit("IV"))
    out = nature.protected_areas(areas)
    t = {(r["status"], r["name"]): r for r in out["by_type"].collect()}
    assert t[("designated", "määramata")]["land_ha"] == 0.0 and t[("designated", "määramata")]["n_land_area"] == 0
    hab = spark.createDataFrame(
        [
            ("versioon 2010", False, 1, "91", "mets", 5.0, "Hästi säilinud"),
            ("versioon 2026", False, 1, "91", "mets", 6.0, "Väga hästi säilinud"),
            ("versioon 2026", False, 2, "91", "mets", 4.0, "hindamata"),
            ("versioon 2026", True, 3, "91", "mets", 9.0, "Hästi säilinud"),
        ],
        "elpst_tyyp_selg string, elupst_on_endine boolean, elpst_obj_id bigint, elupaigatyyp_kood string, elupaigatyyp_grupp_selg string, elupst_pindala_alal double, elupst_kaitse_selg string",
    )
    h = nature.habitats(hab)
    v = {r["version"]: r for r in h["per_version"].collect()}
    assert (v["2026"]["records"], v["2026"]["rated"], v["2026"]["area"]) == (2, 1, 10.0)
    p = h["paired"].first()
    assert (p["from"], p["to"], p["n"], p["improved"]) == ("2010", "2026", 1, 1)
    vep = spark.createDataFrame(
        [("Vääriselupaik", "mets", 1.0, "12.05.1999", "Riik", "On kehtiv leping"), ("Vääriselupaik", None, 2.0, "2001", "Era", None), ("Vääriselupaik", "mets", 3.0, "teadmata", None, None), ("Muu", "mets", 9.0, "2001", "Era", None)],
        "tyyp_selg string, veptyyp_selg string, pindala double, esmane_kp string, omandiv_selg string, kaitse_selg string",
    )
    k = nature.key_habitats(vep)
    assert [(r["year"], r["cum_n"], r["cum_total"]) for r in k["by_year"].orderBy("year").collect()] == [(1999, 1, 1.0), (2001, 2, 3.0)]
    t = k["totals"].first()
    assert (t["n"], t["with_contract"], t["year_unparsed"]) == (3, 1, 1)
    sites = spark.createDataFrame([("Kaitsealune liik", "linnud", 1, "I kategooria", None), ("Kaitsealune liik", None, 2, "II kategooria", None), ("Võõrliik", "taimed", 3, None, "Invasiivne")], "liik_tyyp_selg string, lnim_ryhm_selg string, lnim_id bigint, lnim_kaitsekategooria_selg string, voorliik_tyyp_selg string")
    s = nature.species_sites(sites)["totals"].first()
    assert (s["total_sites"], s["protected_species_sites"], s["alien_sites"], s["invasive_sites"], s["I kategooria"]) == (3, 2, 1, 1, 1)


FOREST = "tabeli_number int, tunnus string, arvutus string, periood string, aasta int, arvvaartus double, suhteline_viga double, " + ", ".join(f"{d} string" for d in forest.DIMS)


def forest_row(table, ind, year, value, err, calc="Summa", period="5", **dims):
    return (table, ind, calc, period, year, value, err, *[dims.get(d) for d in forest.DIMS])


def test_forest(spark):
    land, stocked = forest.LAND, forest.STOCKED
    r = forest_row
    data = []
    for y, f in ((2000, 1.0), (2010, 1.1), (2020, 1.2)):
        data += [
            r(24, "Pindala", y, 100.0 * f, 0.01, maakategooria=land),
            r(24, "Pindala", y, 40.0, 0.02, maakategooria=land, maakond="Harju"),  # sub-total must not leak
            r(24, "Kasvavate puude maht", y, 200.0 * f, 0.02, maakategooria=land),
            r(24, "Kasvavate puude maht", y, 2.0, 0.02, calc="Keskmine", maakategooria=land, maakond="Harju"),
            r(6, "Kasvavate puude maht", y, 150.0, 0.03, maakategooria=land, enamuspuuliik="Mänd"),
            r(6, "Kasvavate puude maht", y, 90.0, float("nan"), maakategooria=land, enamuspuuliik="Kuusk"),
            r(6, "Kasvavate puude maht", y, 240.0, 0.03, maakategooria=land, enamuspuuliik="Puistud"),
            r(5351, "Kuivanud puude maht", y, 3.0, 0.1, maakategooria=land, omand="Riik"),
            r(5351, "Kuivanud puude maht", y, 4.0, 0.1, maakategooria=land, omand="Era"),
            r(5351, "Lamapuidu maht", y, 0.0, None, maakategooria=land, omand="Riik"),
            r(5351, "Lamapuidu maht", y, 5.0, 0.2, maakategooria=land, omand="Era"),
            r(1, "Pindala", y, 100.0, 0.01, maakategooria=stocked),
        ]
        for label, v in (("…20 a", 10.0), ("21…40 a", 20.0), ("41…60 a", 30.0), ("61… a", 40.0), ("21…30 a", 7.0), ("31…40 a", 7.0), ("…10 a", 7.0)):
            data.append(r(13, "Pindala", y, v, 0.1, maakategooria=stocked, omand="Riik", enamuspuuliik="Mänd", filtri_tunnus2="Vanus", filter2=label))
    df = spark.createDataFrame(data, FOREST)
    out = forest.build(df)
    nat = {(x["metric"], x["year"]): (x["value"], x["err"]) for x in out["national"].collect()}
    assert nat[("area", 2000)] == (100.0, 0.01)
    v, e = nat[("deadwood_standing", 2000)]
    assert v == 7.0 and e == pytest.approx((0.3**2 + 0.4**2) ** 0.5 / 7)
    assert nat[("deadwood_lying", 2000)] == (5.0, pytest.approx(0.2))  # the zero part has no error
    v, e = nat[("deadwood_total", 2000)]
    assert v == 12.0 and e == pytest.approx((0.5**2 + 1.0**2) ** 0.5 / 12)
    assert nat[("deadwood_per_ha", 2000)][0] == pytest.approx(0.12)
    ch = {(x["metric"], x["period"]): x for x in out["changes"].collect()}
    c = ch[("area", "since_start")]
    assert c["diff"] == pytest.approx(20.0) and c["half_width"] == pytest.approx((1.0**2 + 1.2**2) ** 0.5) and c["distinguishable"]
    assert ch[("area", "last_10_years")]["from"] == 2010
    assert {x["enamuspuuliik"] for x in out["species"].collect()} == {"Mänd", "Kuusk"}
    assert out["species"].where("enamuspuuliik = 'Kuusk'").first()["err"] is None
    age = {x["filter2"]: x["value"] for x in out["age"].where("year = 2020").collect()}
    assert age == {"…20 a": 10.0, "21…40 a": 20.0, "41…60 a": 30.0, "61… a": 40.0}
    checks = {x["check"]: x["share"] for x in out["checks"].collect()}
    assert checks["species_vs_stock"] == pytest.approx(1.0) and checks["age_vs_stocked_area"] == pytest.approx(1.0)
    assert {x["metric"] for x in out["counties"].collect()} == {"stock_per_ha", "area"}
    steps = out["trace_age"].orderBy("step_no").collect()
    assert steps[0]["rows"] == 21 and all(a["rows"] >= b["rows"] for a, b in zip(steps, steps[1:]))
    d = forest.diagnostics(df)
    shapes = {(x["tabeli_number"], x["tunnus"], x["arvutus"], x["shape"]): x["rows"] for x in d["shapes"].collect()}
    assert shapes[(24, "Pindala", "Summa", "maakategooria+maakond")] == 3
    assert d["examples"].where("tabeli_number = 5351").count() == 4


def test_air_energy(spark):
    em = spark.createDataFrame(
        [
            (1, 2020, "h1", "CO2", "CO2", 100.0, "t", None, "1A1a", "Harju", "Jah"),
            (1, 2020, "h1", "CO2", "CO2", 50.0, "t", None, "1A1a", "Harju", "Jah"),
            (2, 2020, "h2", "CO2", "CO2", 2000.0, "kg", "k", None, None, None),
            (3, 2020, "h3", "NO2", "NO2", 5.0, None, "k", "1A1a", "Harju", "Ei"),
        ],
        "aruanne_id bigint, aruanne_aasta int, heiteallikas_kood string, aine_nimetus string, aine_stat_grupp string, aine_kogus_maarus_yhik double, aine_yhik_maarus string, kytus_kood string, tegevusala_nfr string, tegevuskoht_maakond_nimi_curr string, ets_kohuslane string",
    )
    heat = spark.createDataFrame(
        [(i, 2020, "Maagaas", "tuh m3", 10.0, 86.0, 1.0) for i in range(10)]
        + [(10, 2020, "Maagaas", "tuh m3", 1.0, 900.0, 0.0), (11, 2020, "Maagaas", "tuh m3", None, 5.0, 0.0), (12, 2020, "Hakkpuidu hake", "t", 1.0, 2.3, 0.0)],
        "aruanne_id bigint, aruanne_aasta int, kytus_nimetus_val string, kytus_yhik string, kytus_kogus double, soojus_kokku double, elekter_kokku double",
    )
    out = air_energy.build(em, heat)
    t = {(r["aruanne_aasta"], r["aine_stat_grupp"]): r for r in out["totals"].collect()}
    assert t[(2020, "CO2")]["tonnes"] == pytest.approx(152.0) and t[(2020, "CO2")]["reports"] == 2
    assert out["dropped_units"].first()["rows_unknown_unit"] == 1
    c = out["concentration"].first()
    assert c["top1_share"] == pytest.approx(150 / 152) and c["top5_share"] == pytest.approx(1.0)
    assert out["sensitivity"].first()["gap_share"] == pytest.approx(100 / 152)  # smallest amount counts as first
    assert {r["sector"]: r["total"] for r in out["sectors"].collect()} == {"1A1a": 150.0, "teadmata": 2.0}
    assert {r["ets"]: r["tonnes"] for r in out["ets"].collect()} == {"Jah": 150.0, "teadmata": 2.0}
    f = {r["fuel"]: r for r in out["by_fuel"].collect()}
    assert f["Maagaas"]["heat"] == pytest.approx(860.0) and f["Puit ja biomass"]["reports"] == 1
    assert out["flagged_heat"].first()["flagged_rows"] == 2
    d = air_energy.diagnostics(em, heat)
    assert d["duplicate_keys"].first()["groups_with_multiple_rows"] == 1
    assert d["differences"].first()["excess_if_first_row_only"] == pytest.approx(100.0)


def test_energy_and_heat(spark):
    b = [("2020", i, "TOTAL", v) for i, v in (("PPRD", 100.0), ("IMP", 50.0), ("EXP", 30.0), ("STK_CHG", 5.0), ("GAE", 125.0), ("FC_E", 80.0), ("FC_IND_E", 20.0))]
    b += [("2020", "PPRD", "S2000", 60.0), ("2020", "PPRD", "RA300", 15.0), ("2020", "GAE", "RA300", 25.0), ("2021", "GAE", "TOTAL", None)]
    bal = spark.createDataFrame(b, "Aasta string, `Näitaja` string, `Kütuse/energia liik` string, value double")
    el = spark.createDataFrame(
        [("2020", "PROD_E", p, "_T", v) for p, v in (("_T", 100.0), ("WIND", 20.0), ("S2100_EE", 70.0))] + [("2020", "PROD_E", "WIND", "AUTO", 5.0)],
        "Aasta string, `Näitaja` string, `Kütuse/energia liik` string, `Elektritootja liik` string, value double",
    )
    cap = spark.createDataFrame([("2020", "CAP", "_T", 5.0)], "Vaatlusperiood string, `Näitaja` string, `Elektritootja liik` string, value double")
    out = official.build_energy(bal, el, cap)
    s = out["signs"].first()
    assert (s["sign_a"], s["sign_b"], s["residual_share"]) == (-1, 1, 0.0)
    r = out["balance"].first()
    assert r["net_imports"] == 20.0 and r["dependency_pct"] == pytest.approx(16.0)
    p = out["production"].first()
    assert (p["Põlevkivi"], p["Tuul, päike, hüdro"], p["Muu"], p["renewable"]) == (60.0, 15.0, 25.0, 15.0)
    assert out["renewable_gae"].first()["share_pct"] == pytest.approx(20.0)
    f = out["final"].first()
    assert (f["Tööstus"], f["Transport"], f["total"]) == (20.0, None, 80.0)
    e = out["electricity"].first()
    assert (e["Tuul"], e["Muu"], e["renewable_share_pct"]) == (20.0, 10.0, pytest.approx(20.0))

    nb = "Kütuse/energia liik"
    chp = spark.createDataFrame([("PROD_E_CHP", "CHP_T", "2020", 10.0), ("PROD_H_CHP", "CHP_T", "2020", 20.0), ("PROD_H_CHP", "G1", "2020", 12.0)], "`Näitaja` string, `Generaatori liik` string, Vaatlusperiood string, value double")
    fuels = spark.createDataFrame([("CONS_FUEL_NRG", "CHP_T", "2020", "G3000X3100_3200", 60.0), ("CONS_FUEL_NRG", "CHP_T", "2020", "B5300", 50.0), ("CONS_FUEL_NRG", "CHP_T", "2020", "zz", 10.0)], f"`Näitaja` string, `Generaatori liik` string, Vaatlusperiood string, `{nb}` string, value double")
    mon = spark.createDataFrame([("PROD", f"2020M{m:02d}", "H8000", float(m)) for m in range(1, 13)] + [("PROD", f"2021M{m:02d}", "H8000", 1.0) for m in range(1, 4)], "`Näitaja` string, Vaatlusperiood string, `Energia liik` string, value double")
    h = official.build_heat(chp, fuels, mon)
    assert h["chp"].first()["heat_by_generator"] == {"G1": 12.0}
    r = h["fuels"].first()
    assert (r["Maagaas"], r["Muu"], r["renewable_share_pct"]) == (60.0, 10.0, pytest.approx(100 * 50 / 120))
    assert r["output_to_fuel"] == pytest.approx(30 * 3.6 / 120)
    assert [tuple(x) for x in h["annual"].collect()] == [(2020, 78.0, None)]
    assert h["profile"].first()["months"] == [float(m) for m in range(1, 13)] and h["last_month"].first()[0] == "2021M03"


def test_gases_and_circular(spark):
    g = [("EE", "TOTX4_MEMO", "1990", 40.0), ("EE", "TOTX4_MEMO", "2020", 20.0), ("EE", "CRF1", "1990", 36.0), ("EE", "CRF1", "2020", 9.0), ("EE", "CRF5", "2020", 30.0), ("EU27_2020", "TOTX4_MEMO", "1990", 10.0), ("EU27_2020", "TOTX4_MEMO", "2020", 7.0), ("EE", "TOTXMEMO", "2020", 18.0), ("EE", "CRF1A1", "2020", 4.0)]
    out = official.build_gases(spark.createDataFrame(g, "geo string, src_crf string, time string, value double"))
    s = {r["year"]: r for r in out["sectors"].collect()}
    assert s[1990]["Muu"] == 4.0 and s[2020]["Muu"] == 0.0 and s[1990]["Jäätmed"] is None
    c = {r["year"]: r for r in out["comparison"].collect()}
    assert (c[2020]["own_total"], c[2020]["peer_total"], c[2020]["own_energy"]) == (50.0, 70.0, 25.0)
    assert out["lulucf"].first()["lulucf"] is None and out["energy"].where("year = 2020").first()["Muu"] == 5.0

    mat = spark.createDataFrame([("2010", "9", 5.0), ("2011", "9", 6.0), ("2012", "2", 1.0)], "Aasta string, `Näitaja` string, value double")
    w = []
    for y, total in (("2011", 100.0), ("2012", 120.0)):
        w += [(y, "1", "3", total), (y, "a", "3", 60.0), (y, "b", "3", 30.0), (y, "1", "7", 50.0), (y, "a", "7", 20.0)]
    waste_df = spark.createDataFrame(w, "Aasta string, `Jäätmeliik` string, `Näitaja` string, value double")
    labels = spark.createDataFrame([("a", "010000 mäetööstus"), ("b", "200000 olme"), ("1", "kokku")], "code string, label string")
    act = spark.createDataFrame([("2010", "1", "1", 9.0), ("2010", "1", "x", 4.0), ("2010", "1", "y", 5.0)], "Aasta string, `Jäätmeliik` string, `Tegevusala (EMTAK 2008)` string, value double")
    gdp = spark.createDataFrame([("2010", "2", "1", "1", 10.0), ("2011", "2", "1", "1", 11.0), ("2011", "2", "1", "2", 99.0), ("2012", "2", "1", "1", 12.0)], "Aasta string, `Näitaja` string, Kvartal string, `Sesoonne korrigeerimine` string, value double")
    cmu = spark.createDataFrame([("PC", "EE", "2020", 15.0), ("PC", "EU27_2020", "2019", 12.0)], "unit string, geo string, time string, value double")
    out = official.build_circular(mat, waste_df, act, gdp, cmu, labels, spark.createDataFrame([("x", "Tootmine")], "code string, label string"))
    r = out["waste"].where("year = 2011").first()
    assert (r["generated"], r["generated_excluded"], r["generated_other"], r["recovery_excluded"]) == (100.0, 60.0, 40.0, 20.0)
    assert r["chapter_share"] == pytest.approx(0.9)
    d = {(x["series"], x["year"]): x for x in out["decoupling"].collect()}
    assert d[("gdp", 2011)]["index"] == 100.0 and d[("gdp", 2011)]["base_year"] == 2011 and ("gdp", 2012) not in d
    assert {x["name"]: x["value"] for x in out["activity"].collect()} == {"Tootmine": 4.0, "y": 5.0}
    assert {x["year"]: (x["ee"], x["eu"]) for x in out["cmu"].collect()} == {2020: (15.0, None), 2019: (None, 12.0)}
