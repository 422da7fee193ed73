"""Waste statistics: flows, chapters, hazardous share, partners, stocks and overlapping streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import composition as comp
from tidemark.operators.mergeable import merge_sums, partial_sums
from tidemark.operators.profile import top_values
from tidemark.sources.landed import WASTE_KEYS

#: Flow names, the "yes" mark and the flag columns.
GENERATION = "Jäätmeteke"
RECOVERY = "Taaskasutamine"
LANDFILL = "Ladestatud prügilasse"
HOUSEHOLD = "Saadud kodumajapidamistelt"
EXPORT = "Eksport"
IMPORT = "Import"
STOCK_START = "Laoseis aasta alguses"
STOCK_END = "Laoseis aasta lõpul"
STREAM_FLOWS = (GENERATION, RECOVERY, LANDFILL, HOUSEHOLD, EXPORT, IMPORT)
YES = "Jah"
FLAGS = ("ohtlik_lipp", "biojaatmed_lipp", "reoveesetted_lipp", "metallijaatmed_lipp", "probleemtooted_lipp")


def stream_rules() -> dict:
    flag = lambda c: F.col(c) == YES
    return {
        "municipal": F.col("pohigrupp") == "20",
        "packaging": F.col("jaatmeliik").startswith("15 01"),
        "bio": flag("biojaatmed_lipp"),
        "sludge": flag("reoveesetted_lipp"),
        "metal": flag("metallijaatmed_lipp"),
        "problem": flag("probleemtooted_lipp"),
    }


def aggregate(rows: DataFrame) -> DataFrame:
    """The stored aggregate of raw rows."""
    return partial_sums(rows, WASTE_KEYS, "maht")


def combine(*parts: DataFrame) -> DataFrame:
    return merge_sums(parts, WASTE_KEYS, "maht")


def clean(df: DataFrame) -> DataFrame:
    return df.where(F.col("aasta").isNotNull() & F.col("maht_liik").isNotNull()).withColumns(
        {
            "aasta": F.col("aasta").cast("int"),
            "maht": F.col("maht").cast("double"),
            "neg_sum": F.coalesce("neg_sum", F.lit(0.0)).cast("double"),
        }
    )


def flag_values(df: DataFrame) -> DataFrame:
    """Rows per value of every flag column."""
    cols = [c for c in FLAGS if c in df.columns]
    long = df.select(F.col("rows"), *cols).unpivot(["rows"], cols, "flag", "value")
    return long.groupBy("flag", "value").agg(F.sum("rows").alias("rows"))


def build(agg: DataFrame) -> dict[str, DataFrame]:
    d = clean(agg)
    flow = F.col("maht_liik")
    gen = d.where(flow == GENERATION)
    latest_gen = gen.where(F.col("aasta") == d.agg(F.max("aasta")).scalar())
    rules = stream_rules()
    flows = d.where(flow.isin(*STREAM_FLOWS))
    return {
        "coverage": d.groupBy("aasta").agg(F.sum("rows").alias("rows")),
        "flows": comp.flow_totals(d, ["aasta", "maht_liik"]),
        "by_chapter": comp.flow_totals(d.where(flow.isin(GENERATION, RECOVERY, LANDFILL, HOUSEHOLD)), ["maht_liik", "aasta", "pohigrupp"]),
        "hazardous_generation": comp.flagged_share(gen, ["aasta"], "maht", F.col("ohtlik_lipp") == YES),
        "top_generation": comp.top_types(latest_gen, ["jaatmeliik", "jaatmeliik_nimi"], "maht"),
        "export_partners": comp.top_member_series(d.where(flow == EXPORT), ["aasta"], "partner_riik_nimi", "maht"),
        "import_partners": comp.top_member_series(d.where(flow == IMPORT), ["aasta"], "partner_riik_nimi", "maht"),
        "stock_continuity": comp.stock_continuity(d, "aasta", "maht", flow == STOCK_START, flow == STOCK_END),
        "chapter_names": comp.longest_name(d, "pohigrupp", "pohigrupp_nimi"),
        "stream_flows": comp.stream_flows(flows, rules, ["maht_liik", "aasta"], {"tonnes": "maht", "negative_tonnes": "neg_sum"}),
        "stream_rows": comp.stream_flows(d, rules, [], {"rows": "rows"}),
        "stream_top": comp.stream_top(latest_gen, rules, ["jaatmeliik", "jaatmeliik_nimi"], "maht"),
        "flag_values": flag_values(d),
        "chapters_folded": comp.fold_rest(gen, ["aasta"], "pohigrupp", "maht", 7, "other", positive_only=True),
    }


def grain(raw: DataFrame) -> dict[str, DataFrame]:
    """What one raw row means: totals with negatives, duplicate keys, quantiles, flags and partners."""
    from tidemark.functions.quantiles import NEAREST, group_quantiles
    from tidemark.operators.profile import duplicates

    flow = F.col("maht_liik")
    probs = {f"p{q}": (q / 100, NEAREST) for q in (0, 1, 25, 50, 75, 99, 100)}
    keys = [c for c in raw.columns if c != "maht"]
    sums = [F.count(F.lit(1)).alias("rows"), F.sum("maht").alias("total")]
    return {
        "by_flow": raw.groupBy("maht_liik").agg(*sums, F.count_if(F.col("maht") < 0).alias("neg")),
        "by_flow_chapter": raw.groupBy("maht_liik", "pohigrupp").agg(*sums),
        "duplicates": duplicates(raw, keys, "maht"),
        "quantiles": group_quantiles(raw, [], "maht", probs),
        "flags": top_values(raw, columns=[c for c in FLAGS if c in raw.columns]),
        "partners": raw.where(flow == EXPORT).groupBy("partner_riik_nimi").agg(*sums).orderBy(F.desc("total"), "partner_riik_nimi").limit(15),
    }
