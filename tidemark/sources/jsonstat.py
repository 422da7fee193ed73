"""JSON-stat cubes and their table descriptions as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import let

META = "struct<title:string,variables:array<struct<code:string,text:string,elimination:boolean,time:boolean,values:array<string>,valueTexts:array<string>>>>"


def meta_summary(df: DataFrame, ident: str, doc: str) -> DataFrame:
    """One row per variable: code, text, flags, number of values and its ``(code, text)`` list."""
    m = df.select(ident, F.from_json(doc, META).alias("m"))
    v = m.select(ident, F.col("m.title").alias("title"), F.explode("m.variables").alias("v"))
    return v.select(
        ident,
        "title",
        F.col("v.code").alias("code"),
        F.col("v.text").alias("text"),
        F.coalesce("v.elimination", F.lit(False)).alias("elimination"),
        F.coalesce("v.time", F.lit(False)).alias("time"),
        F.coalesce(F.size("v.values"), F.lit(0)).alias("n"),
        F.arrays_zip(F.col("v.values").alias("code"), F.col("v.valueTexts").alias("text")).alias("values"),
    )


def cells(df: DataFrame, ident: str, doc: str) -> DataFrame:
    """Number of cells of a table: the product of its variable sizes (an empty variable counts once)."""
    sizes = F.transform(F.col("m.variables"), lambda v: F.greatest(F.size(v["values"]), F.lit(1)).cast("bigint"))
    n = F.aggregate(sizes, F.lit(1).cast("bigint"), lambda a, x: a * x)
    return df.select(ident, F.from_json(doc, META).alias("m")).select(ident, n.alias("cells"))


def _codes(doc: str, dim: str) -> Column:
    """Codes of a dimension in index order; the index is a list, or a map from code to position."""
    path = f"$.dimension['{dim}'].category.index"
    text = F.get_json_object(doc, path)
    as_map = F.map_entries(F.from_json(text, "map<string,int>"))
    ordered = F.transform(
        F.array_sort(F.transform(as_map, lambda e: F.struct(e["value"].alias("i"), e["key"].alias("c")))), lambda s: s["c"]
    )
    return F.when(F.trim(text).startswith("["), F.from_json(text, "array<string>")).otherwise(ordered)


def dimension_labels(df: DataFrame, ident: str, doc: str, dims: Sequence[str]) -> DataFrame:
    """``(ident, dim, code, label)`` of the given dimensions."""
    parts = [
        F.struct(F.lit(d).alias("dim"), F.map_entries(F.from_json(F.get_json_object(doc, f"$.dimension['{d}'].category.label"), "map<string,string>")).alias("e"))
        for d in dims
    ]
    rows = df.select(ident, F.explode(F.array(*parts)).alias("p")).select(ident, F.col("p.dim").alias("dim"), F.explode("p.e").alias("e"))
    return rows.select(ident, "dim", F.col("e.key").alias("code"), F.col("e.value").alias("label"))


def _in_order(text: Column, kind: str, n: Column) -> Column:
    """Values of a list, or of a map from cell number to value, as an array in cell order; gaps are null.

    Map entries are ordered once and the gaps between neighbours filled, so the work grows with cells and entries and no
    cell searches the map.  Entries that name no cell are left out.
    """
    entries = F.transform(
        F.map_entries(F.from_json(F.when(F.trim(text).startswith("{"), text), f"map<string,{kind}>")),
        lambda e: F.struct(e["key"].try_cast("bigint").alias("i"), e["key"].alias("k"), e["value"].alias("v")),
    )
    named = F.filter(entries, lambda e: (e["i"].cast("string") == e["k"]) & (e["i"] >= 0) & (e["i"] < n))

    def filled(ordered: Column) -> Column:
        def piece(e: Column, k: Column) -> Column:
            gap = e["i"] - F.coalesce(F.get(ordered, k - 1)["i"], F.lit(-1)) - 1
            return F.concat(F.array_repeat(F.lit(None).cast(kind), gap.cast("int")), F.array(e["v"]))

        return F.flatten(F.transform(ordered, piece))

    listed = F.from_json(F.when(F.trim(text).startswith("["), text), f"array<{kind}>")
    return F.slice(F.coalesce(listed, let(F.array_sort(named), filled), F.array().cast(f"array<{kind}>")), F.lit(1), n.cast("int"))


def flatten(df: DataFrame, doc: str, dims: Sequence[str], ident: Sequence[str] = ()) -> DataFrame:
    """One row per cell with its dimension codes, value and status; dense and sparse values alike.

    The last dimension varies fastest, so a cell number is split by division and remainder instead of
    crossing the dimensions.  ``dims`` is the cube's ``id`` list, in order.  Cells without a value or status have null,
    a cube with an empty dimension has no cells.
    """
    base = df.select(
        *ident,
        *[_codes(doc, d).alias(f"__d{i}") for i, d in enumerate(dims)],
        F.get_json_object(doc, "$.value").alias("__value"),
        F.get_json_object(doc, "$.status").alias("__status"),
    )
    sizes = [F.size(f"__d{i}").cast("bigint") for i in range(len(dims))]
    total = F.lit(1).cast("bigint")
    for s in sizes:
        total = total * s
    n = F.col("__n")
    numbers = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1))
    values, states = _in_order(F.col("__value"), "double", n), _in_order(F.col("__status"), "string", n)
    cell = base.withColumn("__n", total).where(n > 0).withColumn(
        "__c", F.explode(F.arrays_zip(numbers.alias("i"), values.alias("v"), states.alias("s")))
    )
    out, stride = [], F.lit(1).cast("bigint")
    for i in reversed(range(len(dims))):
        at = (F.floor(F.col("__c.i") / stride) % sizes[i] + 1).cast("int")
        out.insert(0, F.element_at(f"__d{i}", at).alias(dims[i].replace("\u00a0", " ")))
        stride = stride * sizes[i]
    return cell.select(*ident, *out, F.col("__c.v").alias("value"), F.col("__c.s").alias("status"))
