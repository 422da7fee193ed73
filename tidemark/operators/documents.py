"""Captions, tags, keyword contexts and field lists from text, HTML, JSON and XML columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, col, keyword_tags, let, ratio
from tidemark.functions.ranks import top_rows
from tidemark.operators.inventory import attribute_values, unescaped

#: Caption lines, label sets and keyword rules.
CAPTION = (
    r"(?i)^\s*(Joonis|Tabel|Figure|Fig\.|Table|Figur|Figuur|Tabell|Tabel|Kuva|Taulukko|Mynd|Tafla)"
    r"\s*[A-Z]?\d+[.:)]?\s*(.*)$"
)
FIGURE_LABELS = ("joonis", "figure", "fig.", "figur", "figuur")
TABLE_LABELS = ("tabel", "table", "tabell")
SECOND_LANGUAGE = ("figure", "table")
FORMS = {
    "time": r"aastail|aastatel|perioodil|muutumi|muutus|dünaamika|utvikling|udvikling|utveckling|"
    r"over tid|\bsiden\b|trend|\b(19|20)\d{2}\s*[-–]\s*(19|20)?\d{2}",
    "composition": r"jagunemi|jaotus|jaotumi|osakaal|fordel|fördel|andel|oppdelt|share",
    "map": r"\bkaart|\bkart\b|\bmap\b|\bkort\b",
}
DIMENSIONS = {
    "geography": r"maakon|jahipiirkon|regio|fylke|kommun|piirkon",
    "species": r"puuliik|enamuspuuliig|treslag|artsgrupp|\barter\b|liigi",
    "age": r"vanus|alder|aldersklasse|hogstklasse|vanuseklass",
    "ownership": r"omand|eraomand|riigimets|eraomanik",
    "diameter": r"diameeter|diameterklasse|rinnasdiameeter",
}
THEMES = {
    "area": r"pindala|areal|arealet|skovareal",
    "stock": r"tagavara|volum|vedmasse|stående|hektaritagavara",
    "increment": r"juurdekasv|tilvækst|tilvekst",
    "felling": r"raie|raiemaht|hugst|hogst|avverk",
    "health_damage": r"tervis|okkakadu|afløvning|nåletab|kahjust|skad",
    "fire_hunting": r"tulekahju|küttimi|jahi",
    "economy": r"hind|raha|turu|majandus|kostnad|tulu",
    "biodiversity": r"elupaik|natura|liigid|surnud puit|dødt ved|habitat",
}
UNCERTAINTY_IN_CAPTION = r"viga|usaldus|confidence|error|konfidens|usikkerhet|standardfejl|osäkerhet"


def lines(df: DataFrame, ident: Sequence[str], text: str) -> DataFrame:
    """``(ident…, line_no, line)`` of a text column."""
    return df.select(*ident, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("line_no", "line"))


def captions(df: DataFrame, ident: Sequence[str], text: str, pattern: str = CAPTION, width: int | None = None) -> DataFrame:
    """Caption lines with their lower-case label and whole text (a listing may ask for its first ``width`` characters)."""
    hit = lines(df, ident, text).where(F.col("line").rlike(pattern))
    whole = F.regexp_extract("line", pattern, 2)
    return hit.select(
        *ident,
        "line_no",
        F.lower(F.regexp_extract("line", pattern, 1)).alias("label"),
        (whole if width is None else F.substring(whole, 1, width)).alias("text"),
    )


def native_captions(caps: DataFrame, doc: str, second: Sequence[str] = SECOND_LANGUAGE) -> DataFrame:
    """Captions in the document's own language: second-language labels go when native ones exist."""
    native = caps.where(~F.col("label").isin(*second)).select(doc).distinct().withColumn("__native", F.lit(True))
    return caps.join(native, doc, "left").where(F.col("__native").isNull() | ~F.col("label").isin(*second)).drop("__native")


def caption_kind(label: ColumnLike, text: ColumnLike, min_length: int = 12) -> Column:
    lab = col(label)
    return F.when(
        F.length(col(text)) > min_length,
        F.when(lab.isin(*FIGURE_LABELS), "figures").when(lab.isin(*TABLE_LABELS), "tables"),
    )


def tag_counts(df: DataFrame, keys: Sequence[str], text: str, families: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Rows per key, rule family and tag; a row counts for every tag it carries, ``none`` for rows without."""
    tagged = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(fam).alias("family"), keyword_tags(text, rules).alias("tags"))
                    for fam, rules in families.items()
                ]
            )
        ).alias("x"),
    )
    tags = F.when(F.size("x.tags") == 0, F.array(F.lit("none"))).otherwise(F.col("x.tags"))
    return (
        tagged.select(*keys, F.col("x.family").alias("family"), F.explode(tags).alias("tag"))
        .groupBy(*keys, "family", "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def classify_captions(caps: DataFrame, doc: str, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document and kind: captions, captions naming uncertainty, rate per 100 pages; and tag counts."""
    kept = native_captions(caps, doc).withColumn("kind", caption_kind("label", "text")).where(F.col("kind").isNotNull())
    summary = kept.groupBy(doc, "kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.lower("text").rlike(UNCERTAINTY_IN_CAPTION)).alias("caption_mentions_uncertainty"),
    )
    if pages is not None:
        summary = summary.join(pages.select(doc, "pages"), doc, "left").withColumn(
            "per_100_pages", F.round(F.lit(100.0) * ratio("n", "pages"), 1)
        )
    families = {"forms": FORMS, "dimensions": DIMENSIONS, "themes": THEMES}
    return summary, tag_counts(kept, [doc, "kind"], "text", families)


def caption_totals(tags: DataFrame, doc: str) -> DataFrame:
    """Tag counts per document and over all documents."""
    return tags.groupingSets([[doc, "kind", "family", "tag"], ["kind", "family", "tag"]], doc, "kind", "family", "tag").agg(
        F.sum("n").alias("n"), F.grouping(doc).alias("all_documents")
    )


def keyword_context(
    df: DataFrame,
    doc: str,
    page: str,
    text: str,
    pattern: str,
    before: int = 70,
    after: int = 90,
    per_document: int | None = None,
) -> DataFrame:
    """First hit per page with its surrounding characters; a listing may ask for ``per_document`` at most."""
    flat = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    rows = df.select(doc, page, flat.alias("__t")).where(F.col("__t").rlike(pattern))
    word = F.regexp_extract("__t", pattern, 0)
    at = F.regexp_instr(F.col("__t"), F.lit(pattern))
    start = F.greatest(at - before, F.lit(1))
    hits = rows.select(
        doc,
        page,
        F.lower(word).alias("word"),
        F.substring(F.col("__t"), start, at + F.length(word) + after - start).alias("context"),
    )
    if per_document is None or doc == page:
        return hits
    return top_rows(hits, [doc], [F.asc(page)], per_document)


def keyword_pages(hits: DataFrame, doc: str, page: str) -> DataFrame:
    """Distinct pages with a keyword hit per document."""
    return hits.groupBy(doc).agg(F.count_distinct(page).alias("keyword_pages"))


def matching_documents(df: DataFrame, keys: Sequence[str], text: str, pattern: str) -> DataFrame:
    """Rows per key, rows mentioning a term, and their share."""
    hit = F.col(text).rlike(pattern)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("mentioning"), ratio(F.count_if(hit), F.count(F.lit(1))).alias("share")
    )


def strip_tags(html: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(col(html), r"<[^>]*>", " ")), r"[\s ]+", " "))


def page_outline(df: DataFrame, ident: str, html: str) -> DataFrame:
    """Title and h1–h3 headings of a page, in order of level and position; headings without text are left out."""

    def of_tag(tag: str) -> Column:
        hits = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), 1)
        return F.transform(hits, lambda s, i: F.struct(F.lit(tag).alias("tag"), i.alias("pos"), strip_tags(s).alias("text")))

    parts = F.flatten(F.array(*[of_tag(t) for t in ("title", "h1", "h2", "h3")]))
    named = df.select(ident, F.explode(parts).alias("x")).select(ident, "x.*")
    return named.where((F.col("tag") == "title") | (F.col("text") != ""))


def links_with_suffix(df: DataFrame, ident: str, html: str, suffix: str = ".pdf") -> DataFrame:
    """Distinct link targets whose path ends with a suffix."""
    out = df.select(ident, F.explode(F.array_distinct(attribute_values(html, "a", "href"))).alias("href"))
    return out.where(F.lower(F.regexp_replace("href", r"[?#].*$", "")).endswith(suffix))


def nested_values(df: DataFrame, ident: str, json: str, fields: Mapping[str, str]) -> DataFrame:
    """Distinct non-blank text values of given keys anywhere in nested JSON: ``(ident, kind, name)``."""

    def of_key(key: str, kind: str) -> Column:
        hits = F.regexp_extract_all(F.col(json), F.lit(rf'"{key}"\s*:\s*"((?:[^"\\]++|\\.)*+)"'), 1)
        text = lambda s: F.get_json_object(F.concat(F.lit('{"v":"'), s, F.lit('"}')), "$.v")
        return F.transform(hits, lambda s: F.struct(F.lit(kind).alias("kind"), F.trim(text(s)).alias("name")))

    found = F.flatten(F.array(*[of_key(k, kind) for k, kind in fields.items()]))
    rows = df.select(ident, F.explode(found).alias("x")).select(ident, "x.kind", "x.name")
    return rows.where(F.col("name") != "").distinct()


def exploded(df: DataFrame, column: str) -> DataFrame:
    """One row per member of a variant object or array: ``(…, pos, key, value)``."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(column).outer()))


#: strings (keys with their colon), brackets, and all between; possessive, so that long strings need no stack
JSON_PIECE = r'(?s)("(?:[^"\\]++|\\.)*+"\s*+:?|[{}\[\]]|[^"{}\[\]]++|")'
#: brackets whose depths are summed in one array
CHUNK = 512


def _depths(events: Column) -> Column:
    """Running sum of ``step`` over the events of a document: within chunks first, then with the chunks' own sums."""
    last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0))
    none = F.array().cast("array<int>")
    starts = F.sequence(F.lit(1), F.greatest(F.size(events), F.lit(1)), F.lit(CHUNK))
    inside = F.transform(starts, lambda at: F.aggregate(F.slice(events, at, F.lit(CHUNK)), none, lambda sums, e: F.array_append(sums, last(sums) + e["step"])))

    def whole(parts: Column) -> Column:
        before = F.aggregate(parts, F.array(F.lit(0)), lambda sums, part: F.array_append(sums, last(sums) + last(part)))
        return let(before, lambda b: F.flatten(F.transform(parts, lambda part, k: F.transform(part, lambda d: d + F.get(b, k)))))

    return let(inside, whole)


def objects_with_key(json: ColumnLike, key: str) -> Column:
    """Texts of the objects, at any depth, that hold a key themselves, in no particular order.

    Brackets and hits of the key are put in order of depth and place: there an object's hit follows its opening
    bracket, and its closing bracket is next.  Text whose brackets don't close gives none; null gives null.
    """
    text = lambda piece: F.regexp_extract(piece, r"(?s)^(.*?)\s*+:$", 1)
    plain = lambda name: F.when(name.contains("\\"), F.get_json_object(F.concat(F.lit('{"v":'), name, F.lit("}")), "$.v")).otherwise(F.substring(name, F.lit(2), F.length(name) - 2))
    hit = lambda piece: piece.startswith('"') & piece.endswith(":") & (plain(text(piece)) == key)

    def event(piece: Column, at: Column) -> Column:
        step = F.when(piece.isin("{", "["), 1).when(piece.isin("}", "]"), -1).when(hit(piece), 0)
        return F.struct(step.alias("step"), at.alias("at"), (piece.isin("{", "}")).alias("of_object"))

    def spans(events: Column, depths: Column) -> Column:
        level = lambda e, i: F.get(depths, i) + F.when(e["step"] < 0, 1).otherwise(0)
        ordered = F.array_sort(F.transform(events, lambda e, i: F.struct(level(e, i).alias("level"), e["at"].alias("at"), e["step"].alias("step"), e["of_object"].alias("of_object"))))

        def pairs(o: Column) -> Column:
            # a repeated key counts once
            once = F.filter(o, lambda e, i: (e["step"] != 0) | (F.coalesce(F.get(o, i - 1)["step"], F.lit(-1)) != 0))
            found = let(once, lambda c: F.transform(c, lambda e, i: F.when((e["step"] == 0) & (F.get(c, i - 1)["step"] == 1) & F.get(c, i - 1)["of_object"] & F.get(c, i + 1)["of_object"], F.struct(F.get(c, i - 1)["at"].alias("a"), F.get(c, i + 1)["at"].alias("b")))))
            return F.filter(found, lambda s: s.isNotNull())

        closed = (F.try_element_at(depths, F.lit(-1)) == 0) & (F.array_min(depths) >= 0)
        return F.when(closed, let(ordered, pairs))

    def objects(pieces: Column) -> Column:
        events = F.filter(F.transform(pieces, event), lambda e: e["step"].isNotNull())
        found = let(events, lambda ev: let(_depths(ev), lambda d: spans(ev, d)))
        return F.transform(found, lambda s: F.array_join(F.slice(pieces, s["a"] + 1, s["b"] - s["a"] + 1), ""))

    return let(F.regexp_extract_all(col(json), F.lit(JSON_PIECE), 1), objects)


def records_with_key(df: DataFrame, ident: str, json: str, key: str) -> DataFrame:
    """``(ident, record)``: objects holding a key anywhere in nested JSON, as they stand in the text, at any depth.

    Rows with null, empty or unbalanced text give no records; repeated rows give theirs each.
    """
    return df.select(ident, F.explode(objects_with_key(json, key)).alias("record"))


#: JSON type names of the listing.
def json_type(schema: Column) -> Column:
    return (
        F.when(schema == "BOOLEAN", "boolean")
        .when(schema == "BIGINT", "integer")
        .when(schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT"), "number")
        .when(schema == "STRING", "string")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema == "VOID", "null")
        .otherwise("unknown")
    )


def _unwrap(text: Column) -> Column:
    """One step into a list or into the first list of a small envelope object (each text is parsed once)."""

    def step(t: Column, members: Column) -> Column:
        first_list = F.try_element_at(F.filter(members, lambda v: v.startswith("[")), F.lit(1))
        return (
            F.when(t.startswith("["), F.coalesce(F.get_json_object(t, "$[0]"), F.lit("{}")))
            .when(t.startswith("{") & (F.size(members) <= 3), F.coalesce(first_list, t))
            .otherwise(t)
        )

    return let(F.trim(text), lambda t: let(F.map_values(F.from_json(t, "map<string,string>")), lambda m: step(t, m)))


def json_fields(df: DataFrame, ident: Sequence[str], json: str) -> DataFrame:
    """``(ident…, field, type)`` of the first record of a payload, envelopes unwrapped up to three times."""
    rec = F.col(json)
    for _ in range(3):
        rec = _unwrap(rec)
    rows = df.select(*ident, F.explode(F.map_entries(F.from_json(rec, "map<string,variant>"))).alias("e"))
    return rows.select(*ident, F.col("e.key").alias("field"), json_type(F.schema_of_variant("e.value")).alias("type"))


#: comments, character data and declarations with what they hold; tags, whose quoted values may hold ``>``
XML_PIECE = (
    r"(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)|<![^>]*+>"
    r"""|(<[^\s<>!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>)"""
)
#: the tag's name, then its attributes one after another
XML_ATTRIBUTE = r"""(?s)\G(?:<[^\s/>]++|\s*+([^\s=/>]++)\s*+=\s*+(?:"[^"]*+"|'[^']*+'))"""


def xml_fields(df: DataFrame, ident: str, xml: str) -> DataFrame:
    """``(ident, field, type)`` of the first record: the most repeated child element of the document root.

    Tags become rows; a running count of opened and closed tags within a document gives their depth.
    """
    tags = F.filter(F.regexp_extract_all(F.col(xml), F.lit(XML_PIECE), 1), lambda t: t != "")
    t = df.select(ident, F.posexplode(tags).alias("pos", "tag"))
    closing, single = F.col("tag").startswith("</"), F.col("tag").endswith("/>")
    w = Window.partitionBy(ident).orderBy("pos")
    step = F.when(closing, -1).when(single, 0).otherwise(1)
    opened = (
        t.withColumn("after", F.sum(step).over(w))
        .withColumn("depth", F.col("after") - step)
        .where(~closing)
        .withColumn("name", F.regexp_extract("tag", r"^<([^\s/>]+)", 1))
        .withColumn("parent", F.max(F.when(F.col("depth") == 1, F.col("pos"))).over(w))
    )
    kids = opened.where(F.col("depth") == 1).groupBy(ident, "name").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    record = kids.groupBy(ident).agg(F.max(F.struct(F.col("n"), (-F.col("first")).alias("p"))).alias("o")).select(
        ident, (-F.col("o.p")).alias("record")
    )
    marked = opened.join(record, ident)
    elements = marked.where((F.col("depth") == 2) & (F.col("parent") == F.col("record"))).select(
        ident, F.col("name").alias("field"), F.lit("element").alias("type")
    )
    attrs = F.filter(F.regexp_extract_all(F.col("tag"), F.lit(XML_ATTRIBUTE), 1), lambda a: a != "")
    attributes = marked.where(F.col("pos") == F.col("record")).select(ident, F.explode(attrs).alias("a")).select(
        ident, F.concat(F.lit("@"), "a").alias("field"), F.lit("attribute").alias("type")
    )
    return attributes.unionByName(elements).distinct()


PROPERTY = "struct<type:string,format:string,description:string>"
DEFINITION = f"struct<description:string,required:array<string>,properties:map<string,{PROPERTY}>>"
OPERATION = "struct<summary:string,operationId:string>"


def api_schemas(df: DataFrame, api: str, doc: str) -> DataFrame:
    """Table definitions of an API description (version 2 or 3): one row per table."""
    v2 = F.from_json(F.get_json_object(doc, "$.definitions"), f"map<string,{DEFINITION}>")
    v3 = F.from_json(F.get_json_object(doc, "$.components.schemas"), f"map<string,{DEFINITION}>")
    rows = df.select(api, F.explode(F.map_entries(F.coalesce(v2, v3))).alias("e"))
    return rows.where(F.col("e.value.properties").isNotNull()).select(
        api,
        F.col("e.key").alias("table"),
        F.coalesce("e.value.description", F.lit("")).alias("description"),
        F.coalesce("e.value.required", F.array().cast("array<string>")).alias("required"),
        F.col("e.value.properties").alias("properties"),
        F.size("e.value.properties").alias("n_columns"),
    )


def api_columns(schemas: DataFrame, api: str) -> DataFrame:
    """One row per table and column with type, format and whether it is required."""
    rows = schemas.select(api, "table", "required", F.explode(F.map_entries("properties")).alias("e"))
    return rows.select(
        api,
        "table",
        F.col("e.key").alias("column"),
        F.coalesce("e.value.type", F.lit("")).alias("type"),
        F.coalesce("e.value.format", F.lit("")).alias("format"),
        F.array_contains("required", F.col("e.key")).alias("required"),
        F.regexp_replace(F.coalesce("e.value.description", F.lit("")), "\n", " ").alias("description"),
    )


def api_operations(df: DataFrame, api: str, doc: str) -> DataFrame:
    """One row per path and HTTP method."""
    methods = ("get", "post", "put", "patch", "delete", "head")
    paths = F.from_json(F.get_json_object(doc, "$.paths"), "map<string,map<string,string>>")
    rows = df.select(api, F.explode(F.map_entries(paths)).alias("p")).select(
        api, F.col("p.key").alias("path"), F.explode(F.map_entries("p.value")).alias("m")
    )
    ops = rows.where(F.lower("m.key").isin(*methods)).withColumn("op", F.from_json("m.value", OPERATION))
    return ops.where(F.col("op").isNotNull()).select(
        api,
        F.upper("m.key").alias("method"),
        "path",
        F.coalesce("op.summary", F.lit("")).alias("summary"),
        F.coalesce("op.operationId", F.lit("")).alias("operation_id"),
    )
