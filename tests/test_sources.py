import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import mergeable as mg
from tidemark.operators import profile as pf
from tidemark.sources import jsonstat, landed, sinks
from tidemark.sources.staging import staged
from tidemark.streaming.daily import stream_daily
from tidemark.streaming.incremental import compact, merged_parts, store_parts


def test_reconciliation_finds_missing_mismatching_and_broken_parts(spark, tmp_path):
    root = tmp_path / "parts"
    for y, n in ((2019, 3), (2020, 2)):
        spark.range(n).select(F.lit(y).alias("year"), F.col("id").alias("v")).coalesce(1).write.parquet(str(root / str(y)))
    broken = root / "2021"
    broken.mkdir()
    (broken / "bad.parquet").write_bytes(b"PAR1 this is not parquet PAR1")
    with pytest.raises(Exception, match="bad.parquet"):
        landed.read_parts(spark, str(root), "year int, v bigint").count()
    parts = landed.read_parts(spark, str(root), "year int, v bigint", leave_damaged=True)
    expected = spark.createDataFrame([(2019, 3), (2020, 5), (2021, 1)], "year int, rows_expected bigint")
    wanted = mg.expected_years(spark, 2018, 2021, [0]).join(expected, "year", "full")
    rec = mg.reconcile(landed.year_counts(parts), wanted)
    assert {r["year"]: r["status"] for r in rec.collect()} == {0: "missing", 2018: "missing", 2019: "ok", 2020: "mismatch", 2021: "missing"}
    rep = mg.completeness_report(rec).first()
    assert rep["years_missing"] == [0, 2018, 2021] and rep["years_mismatch"] == [2020] and not rep["complete"]
    whole = [r["file"] for r in parts.selectExpr("substring_index(part_file, '/', -1) as file").distinct().collect()]
    files = spark.createDataFrame([("bad.parquet", 1), *[(f, None) for f in whole]], "file string, rows_expected bigint")
    broken = landed.broken_parts(parts, files)
    assert [tuple(r) for r in broken.collect()] == [("bad.parquet", 1, 0)]
    short = landed.broken_parts(parts, spark.createDataFrame([(f, 9) for f in whole], "file string, rows_expected bigint"))
    assert short.count() == len(whole)  # partly read files are named too
    fine = mg.reconcile(landed.year_counts(parts), landed.year_counts(parts).withColumnRenamed("rows_read", "rows_expected"))
    assert mg.completeness_report(fine).first()["complete"] and not mg.completeness_report(fine, broken).first()["complete"]


def test_guards(spark):
    df = spark.createDataFrame([("1", "x", "12.5", "Mari"), ("2", "y", "abc", "Jaan")], "id string, kood string, vaartus_arv_moodetud string, isik_nimi string")
    n = landed.normalise(landed.drop_private(df, ("isik_",)))
    assert dict(n.dtypes) == {"vaartus_arv_moodetud": "double", "id": "string", "kood": "string"}
    assert [r["vaartus_arv_moodetud"] for r in n.orderBy("id").collect()] == [12.5, None]
    with pytest.raises(landed.RowCountMismatch):
        landed.require_count(df, 3, "t")
    assert landed.require_count(df, 2, "t") is df
    with pytest.raises(ValueError):
        landed.only_allowed(df, ["id"])
    empty = landed.read_or_empty(spark, None, landed.CLIMATE)
    assert empty.columns[0] == "jaam_kood" and empty.isEmpty()
    ts = spark.createDataFrame([("1994-12-31",), ("1995-01-01",), ("1996-01-01",)], "t string")
    assert landed.read_years(ts, "t", [0, 1995]).count() == 2
    assert ts.where(landed.equals({"t": "1995-01-01"})).count() == 1


def test_catalogue_reads(spark):
    cat = spark.createDataFrame(
        [([(1, [("WT avg", 5), ("Q", None)]), (2, [("WT avg", 50)])],)],
        "stations array<struct<jaam_kood bigint, series array<struct<series string, rows bigint>>>>",
    )
    assert [r[0] for r in landed.select_stations(cat, "WT avg", 10).collect()] == [2]
    df = spark.createDataFrame([("a", 1, "t2"), ("a", 2, "t1"), (None, 3, "t0")], "k string, i int, t string")
    assert [tuple(r) for r in landed.discover(df, "k", ["i"]).collect()] == [("a", 1)]
    assert landed.series_coverage(df, ["k"], "t").where("k = 'a'").first()["first"] == "t1"


CUBE = {
    "id": ["A", "B C"],
    "dimension": {
        "A": {"category": {"index": {"y": 1, "x": 0}, "label": {"x": "ex", "y": "why"}}},
        "B C": {"category": {"index": ["1", "2", "3"], "label": {"1": "one", "2": "two", "3": "three"}}},
    },
}


def test_jsonstat(spark):
    dense = {**CUBE, "value": [1, None, 3, 4, 5, 6], "status": {"1": "n"}}
    sparse = {**CUBE, "value": {"0": 1.5, "5": 9}}
    df = spark.createDataFrame([("d", json.dumps(dense)), ("s", json.dumps(sparse))], "k string, doc string")
    got = {(r["k"], r["A"], r["B C"]): (r["value"], r["status"]) for r in jsonstat.flatten(df, "doc", ["A", "B C"], ["k"]).collect()}
    assert len(got) == 12
    assert got[("d", "x", "1")] == (1.0, None) and got[("d", "x", "2")] == (None, "n") and got[("d", "y", "3")] == (6.0, None)
    assert got[("s", "x", "1")] == (1.5, None) and got[("s", "y", "3")] == (9.0, None) and got[("s", "y", "1")] == (None, None)
    labels = {(r["dim"], r["code"]): r["label"] for r in jsonstat.dimension_labels(df, "k", "doc", ["A", "B C"]).where("k = 'd'").collect()}
    assert labels[("A", "y")] == "why" and labels[("B C", "3")] == "three"
    meta = {"title": "T", "variables": [{"code": "a", "text": "A", "time": True, "values": ["1", "2"], "valueTexts": ["one", "two"]}, {"code": "b", "text": "B", "values": [], "valueTexts": []}]}
    m = spark.createDataFrame([("t", json.dumps(meta))], "k string, doc string")
    v = {r["code"]: r for r in jsonstat.meta_summary(m, "k", "doc").collect()}
    assert v["a"]["n"] == 2 and v["a"]["time"] and not v["a"]["elimination"] and v["a"]["values"][1]["text"] == "two"
    assert jsonstat.cells(m, "k", "doc").first()["cells"] == 2


def test_sparse_cube_of_many_cells(spark):
    side = 300
    codes = [f"c{k}" for k in range(side)]
    dimension = {d: {"category": {"index": codes}} for d in "AB"}
    filled = {str(k): k / 4 for k in range(0, side * side, 3)} | {"x": 1, "90000": 2, "-1": 3, "07": 4}
    docs = [("s", {"value": filled, "status": {"4": "e"}}), ("none", {"value": {}}), ("short", {"value": [5]}), ("null", {})]
    df = spark.createDataFrame([(k, json.dumps({"dimension": dimension} | d)) for k, d in docs], "k string, doc string")
    cells = jsonstat.flatten(df, "doc", ["A", "B"], ["k"])
    got = {r["k"]: r for r in cells.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"), F.sum("value").alias("total"), F.count("status").alias("states")).collect()}
    assert {k: r["n"] for k, r in got.items()} == dict.fromkeys(("s", "none", "short", "null"), side * side)
    assert got["s"]["filled"] == side * side // 3 and got["s"]["total"] == sum(range(0, side * side, 3)) / 4 and got["s"]["states"] == 1
    assert got["none"]["filled"] == got["null"]["filled"] == 0 and got["short"]["filled"] == 1
    some = cells.where("k = 's' and A = 'c2'").where(F.col("B").isin("c0", "c3", "c4")).orderBy("B").collect()
    assert [(r["B"], r["value"]) for r in some] == [("c0", 150.0), ("c3", 150.75), ("c4", None)]


def test_csv_and_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("b", "q", 2)], "x string, y string, z int")
    sinks.write_csv(df, str(tmp_path / "c"), ["y", "x", "w"])
    back = sinks.read_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["y", "x", "w"] and {tuple(r) for r in back.collect()} == {("", "a", ""), ("q", "b", "")}
    doc = sinks.series_document(spark.createDataFrame([("k", 2001, 1.23456), ("k", 2000, None)], "k string, year int, v double"), ["k"], "year", ["v"]).first()
    assert json.loads(doc["document"]) == [{"year": 2000}, {"year": 2001, "v": 1.235}]
    sinks.write_by_year(df.withColumn("year", F.col("z") + 2000), str(tmp_path / "y"))
    sinks.write_by_year(df.where("z = 2").withColumn("year", F.col("z") + 2000), str(tmp_path / "y"))
    assert spark.read.parquet(str(tmp_path / "y")).count() == 2
    sinks.write_sections({"a.b": df}, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s" / "a" / "b")).count() == 2
    assert staged(df).count() == 2


def test_profiles(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("", 3.0), (None, 3.0)], "s string, v double")
    d = {r["column"]: r for r in pf.describe(df, empty_is_null=True).collect()}
    assert d["s"]["null_share"] == 0.5 and d["v"]["v_max"] == 3.0 and d["v"]["distinct"] == 3
    assert pf.top_values(df, top=1).where("column = 'v'").first()["value"] == "3.0"
    df.write.parquet(str(tmp_path / "t"))
    df.coalesce(1).write.parquet(str(tmp_path / "cut"))
    part = next((tmp_path / "cut").glob("part*"))
    raw = bytearray(part.read_bytes())
    raw[4:60] = b"\xff" * 56  # the footer stays readable
    part.write_bytes(raw)
    next((tmp_path / "cut").glob(".part*.crc")).unlink()
    found, index = landed.profile_tables(spark, {"t": str(tmp_path / "t"), "k_isik": "x", "gone": str(tmp_path / "no"), "cut": str(tmp_path / "cut")})
    assert set(found) == {"t"}
    assert {r["table_name"]: r["status"].split(":")[0] for r in index.collect()} == {"t": "ok", "k_isik": "skipped", "gone": "failed", "cut": "failed"}
    big = spark.range(10000).withColumnRenamed("id", "k")
    sample = pf.even_sample(big, "k", 5, 40)
    assert sample.count() == 200 and sample.distinct().count() == 200
    assert pf.even_sample(big.limit(50), "k", 5, 40).count() == 50
    assert pf.join_coverage(big, "k", big.where("k < 10"), "k").first()["found_in_register"] == 10


def test_stream_equals_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src)
    folder = tmp_path / "in"
    batch.repartition(4).write.parquet(str(folder))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    q = store_parts(stream, ["event_type"], "value", str(tmp_path / "parts"), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    cents = lambda df: {r["event_type"]: (round(r["value"], 2), r["rows"], r["neg_rows"]) for r in df.collect()}
    want = cents(mg.partial_sums(batch, ["event_type"], "value"))
    assert cents(merged_parts(spark, str(tmp_path / "parts"), ["event_type"], "value")) == want
    compact(spark, str(tmp_path / "parts"), str(tmp_path / "one"), ["event_type"], "value")
    assert cents(merged_parts(spark, str(tmp_path / "one"), ["event_type"], "value")) == want


def test_daily_stream(spark, tmp_path):
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = tmp_path / "in"
    batch.coalesce(1).write.parquet(str(folder))
    stream = spark.readStream.schema(batch.schema).parquet(str(folder))
    days = stream_daily(stream, ["event_type"], "ts", "value", watermark="1 day")
    q = days.writeStream.format("memory").queryName("days_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["event_type"], str(r["date"])): (round(r["value"], 6), r["n_hours"]) for r in spark.table("days_out").collect()}
    want = batch.groupBy("event_type", F.to_date("ts").alias("date")).agg(F.avg("value").alias("v"), F.count(F.lit(1)).alias("n")).collect()
    assert got == {(r["event_type"], str(r["date"])): (round(r["v"], 6), r["n"]) for r in want}
