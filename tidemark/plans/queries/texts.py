"""URLs, page links and outlines, keyword tags and contexts, captions, JSON and API fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import documents as doc
from tidemark.operators import inventory as inv
from tidemark.plans.queries.registry import query, rounded, table

URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


@query(
    "url_parts",
    "I01 I02 I03 I08",
    rf"""WITH u AS (SELECT page_id, trim(url) AS url FROM pages)
SELECT page_id, lower(regexp_extract(url, '{URL}', 1)) || '://' || lower(regexp_extract(url, '{URL}', 2)) || rtrim(url_decode(regexp_extract(url, '{URL}', 3)), '/') AS page,
regexp_extract(url, '{URL}', 2) AS host,
CASE WHEN contains(lower(regexp_extract(url, '{URL}', 2)), 'example.com') THEN 'commercial' WHEN contains(lower(regexp_extract(url, '{URL}', 2)), 'example.org') THEN 'organisation' ELSE 'other' END AS technology,
CASE WHEN contains(lower(regexp_extract(url, '{URL}', 2)), 'example.com') THEN 'own' ELSE 'unknown' END AS owner,
contains(lower(regexp_extract(url, '{URL}', 2)), 'example.com') OR contains(lower(regexp_extract(url, '{URL}', 2)), 'example.org') AS is_platform
FROM u""",
)
def url_parts(spark, sf):
    platforms = (("example.com", "commercial"), ("example.org", "organisation"))
    p = table(spark, sf, "pages").select("page_id", inv.norm_page("url").alias("page"), inv.host_of("url").alias("host"), "url")
    tech = inv.technology("host", None, platforms)
    out = p.withColumns({"technology": tech, "is_platform": inv.is_platform("url", platforms)})
    return out.withColumn("owner", inv.owner("technology", [("commercial", "own")])).drop("url")


@query(
    "workbook_view",
    "I07",
    r"""WITH p AS (SELECT p_partkey, p_size % 4 AS kind, lower(p_type) || p_size AS book, p_name AS name FROM part)
SELECT p_partkey, CASE kind WHEN 2 THEN upper(book) WHEN 3 THEN '' ELSE book END AS workbook, CASE WHEN kind < 2 THEN name ELSE '' END AS view FROM p""",
)
def workbook_view(spark, sf):
    kind, site = F.col("p_size") % 4, F.concat(F.lit("https://"), F.lower("p_type"), F.lit(".org"))
    book, name = F.concat(F.lower("p_type"), F.col("p_size").cast("string")), F.replace("p_name", F.lit(" "), F.lit("%20"))
    link = (
        F.when(kind == 0, F.concat(site, F.lit("/views/"), book, F.lit("/"), name, F.lit("?a="), "p_partkey"))
        .when(kind == 1, F.concat(site, F.lit("/static/images/"), F.right("p_brand", F.lit(1)), F.lit("x/"), book, F.lit("/"), name, F.lit("/1.png")))
        .when(kind == 2, F.concat(site, F.lit("/shared/"), F.upper(book)))
        .otherwise(F.concat(site, F.lit("/"), name, F.lit("?to=/views/a/b")))
    )
    book, view = inv.workbook_view("link")
    return table(spark, sf, "part").select("p_partkey", link.alias("link")).select("p_partkey", book.alias("workbook"), view.alias("view"))


@query(
    "page_links",
    "I09 I23",
    # whole tags first, then their attributes one by one
    r"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<(?:a|img|iframe|script|tableau-viz)\s[^>]*>')) AS tag FROM pages),
a AS (SELECT page_id, lower(regexp_extract(tag, '^<([A-Za-z-]+)', 1)) AS element, unnest(regexp_extract_all(tag, '(?is)\s(?:href|src|data-src)\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)')) AS pair FROM t),
v AS (SELECT page_id, element, lower(regexp_extract(pair, '(?is)^\s([a-z-]+)', 1)) AS name, regexp_replace(regexp_replace(pair, '(?is)^\s[a-z-]+\s*=\s*', ''), '^["'']|["'']$', '', 'g') AS raw FROM a),
l AS (SELECT page_id, CASE element WHEN 'a' THEN 'link' ELSE element END AS kind,
      trim(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS src
      FROM v WHERE (element = 'a') = (name = 'href') AND (name <> 'data-src' OR element = 'iframe'))
SELECT page_id, kind, src, count(*) AS n FROM l WHERE src <> '' GROUP BY 1, 2, 3""",
)
def page_links(spark, sf):
    links = inv.page_links(table(spark, sf, "pages"), "page_id", "html")
    return links.groupBy("page_id", "kind", "src").agg(F.count(F.lit(1)).alias("n"))


@query(
    "platform_links",
    "I08 I09",
    # targets without a host belong to the page's, which is put on a platform
    r"""WITH l AS (SELECT page_id, replace(unnest(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"', 1)), '&amp;', '&') AS src FROM pages),
f AS (SELECT page_id, CASE WHEN regexp_matches(src, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN src WHEN src LIKE '/%' THEN 'https://viz.tableau.example' || src WHEN src LIKE '#%' OR src LIKE '?%' THEN 'https://viz.tableau.example/p/' || page_id || src
      ELSE 'https://viz.tableau.example/p/' || src END AS src FROM l WHERE src <> '')
SELECT DISTINCT page_id, 'link' AS kind, src, 'viz.tableau.example' AS host, '' AS workbook, '' AS view FROM f WHERE src LIKE 'https://viz.tableau.example/%'""",
)
def platform_links(spark, sf):
    pages = table(spark, sf, "pages").withColumn("base", F.concat(F.lit("https://viz.tableau.example/p/"), F.col("page_id").cast("string")))
    return inv.link_rows(inv.page_links(pages, "page_id", "html", "base").where("kind = 'link'"), "page_id")


@query(
    "page_outline",
    "I23",
    r"""WITH t AS (SELECT page_id, 'title' AS tag, regexp_extract_all(html, '(?is)<title\b[^>]*>(.*?)</title>', 1) AS x FROM pages
UNION ALL SELECT page_id, 'h1', regexp_extract_all(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1) FROM pages
UNION ALL SELECT page_id, 'h2', regexp_extract_all(html, '(?is)<h2\b[^>]*>(.*?)</h2>', 1) FROM pages
UNION ALL SELECT page_id, 'h3', regexp_extract_all(html, '(?is)<h3\b[^>]*>(.*?)</h3>', 1) FROM pages),
e AS (SELECT page_id, tag, unnest(x) AS raw, unnest(range(0, len(x))) AS pos FROM t),
p AS (SELECT page_id, tag, CAST(pos AS INTEGER) AS pos, replace(replace(replace(replace(replace(replace(regexp_replace(raw, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS raw FROM e),
o AS (SELECT page_id, tag, pos, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS text FROM p)
SELECT * FROM o WHERE tag = 'title' OR text <> ''""",
)
def page_outline(spark, sf):
    return doc.page_outline(table(spark, sf, "pages"), "page_id", "html")


RULES = {
    "forms": {"time": r"\bthe\b.*\bwas\b", "share": "share|ing "},
    "dimensions": {"area": "ment", "age": "tion"},
}


@query(
    "keyword_tags",
    "I18 I20",
    r"""WITH d AS (SELECT doc_id, lower(replace(text, chr(10), ' ')) AS t FROM documents),
g AS (SELECT doc_id, 'forms' AS family, 'time' AS tag FROM d WHERE regexp_matches(t, '\bthe\b.*\bwas\b') UNION ALL SELECT doc_id, 'forms', 'share' FROM d WHERE regexp_matches(t, 'share|ing ')
UNION ALL SELECT doc_id, 'forms', 'none' FROM d WHERE NOT regexp_matches(t, '\bthe\b.*\bwas\b') AND NOT regexp_matches(t, 'share|ing ')
UNION ALL SELECT doc_id, 'dimensions', 'area' FROM d WHERE contains(t, 'ment') UNION ALL SELECT doc_id, 'dimensions', 'age' FROM d WHERE contains(t, 'tion')
UNION ALL SELECT doc_id, 'dimensions', 'none' FROM d WHERE NOT contains(t, 'ment') AND NOT contains(t, 'tion'))
SELECT lang, family, tag, count(*) AS n FROM g JOIN documents USING (doc_id) GROUP BY 1, 2, 3""",
)
def keyword_tags(spark, sf):
    d = table(spark, sf, "documents").withColumn("t", F.replace("text", F.lit("\n"), F.lit(" ")))
    return doc.tag_counts(d, ["lang"], "t", RULES)


@query(
    "caption_tags",
    "I19 I20 I21",
    r"""WITH l AS (SELECT doc_id, source, unnest(string_split_regex(text, '\r?\n')) AS line FROM documents),
c AS (SELECT doc_id, source, CASE WHEN length(line) % 3 = 0 THEN 'tabel' WHEN length(line) % 3 = 1 THEN 'figure' ELSE 'joonis' END AS label, line AS text FROM l WHERE line <> ''),
n AS (SELECT DISTINCT doc_id FROM c WHERE label NOT IN ('figure', 'table')),
k AS (SELECT source, CASE WHEN label IN ('joonis', 'figure') THEN 'figures' ELSE 'tables' END AS kind, lower(text) AS t FROM c
      WHERE length(text) > 12 AND NOT (label IN ('figure', 'table') AND doc_id IN (SELECT doc_id FROM n)))
SELECT source, kind, count(*) AS n, count(*) FILTER (regexp_matches(t, 'viga|usaldus|confidence|error|konfidens|usikkerhet|standardfejl|osäkerhet')) AS uncertain FROM k GROUP BY 1, 2""",
)
def caption_tags(spark, sf):
    lines = doc.lines(table(spark, sf, "documents"), ["doc_id", "source"], "text").where(F.col("line") != "")
    n = F.length("line") % 3
    caps = lines.select("doc_id", "source", F.when(n == 0, "tabel").when(n == 1, "figure").otherwise("joonis").alias("label"), F.col("line").alias("text"))
    summary, _ = doc.classify_captions(caps, "doc_id")
    src = table(spark, sf, "documents").select("doc_id", "source")
    return summary.join(src, "doc_id").groupBy("source", "kind").agg(
        F.sum("n").alias("n"), F.sum("caption_mentions_uncertainty").alias("uncertain")
    )


@query(
    "caption_lines",
    "I22",
    r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (regexp_matches(line, '^\s*(Der|The|Les|Los)\s+(.*)$')) AS captions,
coalesce(max(CASE WHEN regexp_matches(line, '^\s*(Der|The|Les|Los)\s+(.*)$') THEN regexp_extract(line, '^\s*(Der|The|Les|Los)\s+(.*)$', 2) END), '') AS last_text FROM l GROUP BY 1""",
)
def caption_lines(spark, sf):
    d = table(spark, sf, "documents")
    pattern = r"^\s*(Der|The|Les|Los)\s+(.*)$"
    total = doc.lines(d, ["doc_id"], "text").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))
    caps = doc.captions(d, ["doc_id"], "text", pattern).groupBy("doc_id").agg(F.count(F.lit(1)).alias("captions"), F.max("text").alias("last_text"))
    return total.join(caps, "doc_id", "left").na.fill({"captions": 0, "last_text": ""})


@query(
    "keyword_context",
    "I22",
    r"""WITH d AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents),
m AS (SELECT doc_id, t, regexp_extract(t, '(?i)(confidence|uncertaint[a-z]*|trend[a-z]*|target[a-z]*|ing on|tion der)', 0) AS w FROM d),
p AS (SELECT *, instr(t, w) AS p0 FROM m WHERE w <> '')
SELECT doc_id, doc_id AS page, lower(w) AS word, substr(t, greatest(p0 - 70, 1), p0 + length(w) + 90 - greatest(p0 - 70, 1)) AS context FROM p""",
)
def keyword_context(spark, sf):
    d = table(spark, sf, "documents").withColumn("page", F.col("doc_id"))
    pattern = "(?i)(confidence|uncertaint[a-z]*|trend[a-z]*|target[a-z]*|ing on|tion der)"
    return doc.keyword_context(d, "doc_id", "page", "text", pattern, per_document=None)


@query(
    "term_pages",
    "I22",
    r"""SELECT lang, source, count(*) AS n, count(*) FILTER (regexp_matches(text, '(?i)\b(mets|skog|forest|skov|der|the)[a-z]*')) AS mentioning,
round(count(*) FILTER (regexp_matches(text, '(?i)\b(mets|skog|forest|skov|der|the)[a-z]*')) / count(*), 6) AS share FROM documents GROUP BY 1, 2""",
)
def term_pages(spark, sf):
    return rounded(doc.matching_documents(table(spark, sf, "documents"), ["lang", "source"], "text", r"(?i)\b(mets|skog|forest|skov|der|the)[a-z]*"))


@query(
    "json_fields",
    "I15",
    """WITH f AS (SELECT event_type, unnest(json_keys(props)) AS field, props FROM events)
SELECT event_type, field, CASE json_type(props, '$.' || field) WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' ELSE 'other' END AS type, count(*) AS n FROM f GROUP BY 1, 2, 3""",
)
def json_fields(spark, sf):
    f = doc.json_fields(table(spark, sf, "events"), ["event_id", "event_type"], "props")
    return f.groupBy("event_type", "field", "type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "nested_names",
    "I11",
    """SELECT event_id, 'kind' AS kind, event_type AS name FROM events UNION ALL SELECT event_id, 'user', 'u' || user_id FROM events""",
)
def nested_names(spark, sf):
    nested = F.to_json(
        F.struct(F.array(F.struct(F.col("event_type").alias("caption"), F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("who")).alias("x"))).alias("items"))
    )
    ev = table(spark, sf, "events").select("event_id", nested.alias("j"))
    return doc.nested_values(ev, "event_id", "j", {"caption": "kind", "who": "user"})


@query(
    "records_with_key",
    "I26",
    """SELECT event_id, count(*) AS n FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_type = 'click') GROUP BY 1""",
)
def records_with_key(spark, sf):
    rec = F.struct(F.col("user_id").alias("repo"), F.col("value").alias("v"))
    js = F.to_json(F.struct(F.array(rec, F.when(F.col("event_type") == "click", rec)).alias("items"), F.lit(1).alias("z")))
    ev = table(spark, sf, "events").select("event_id", js.alias("j"))
    return doc.records_with_key(ev, "event_id", "j", "repo").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "xml_fields",
    "I25",
    """WITH e AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, '@id' AS field, 'attribute' AS type FROM e UNION ALL SELECT event_id, '@note', 'attribute' FROM e WHERE value > 10
UNION ALL SELECT event_id, event_type, 'element' FROM e UNION ALL SELECT event_id, 'props', 'element' FROM e WHERE k % 2 = 0""",
)
def xml_fields(spark, sf):
    ident, k = F.col("event_id").cast("string"), F.get_json_object("props", "$.k").cast("bigint")
    note = F.when(F.col("value") > 10, F.concat(F.lit(" note='props=\"0\" > "), F.col("value").cast("string"), F.lit("'")))
    child = F.concat(F.lit("<"), "event_type", F.lit(' of="a>b">&lt;'), F.col("user_id").cast("string"), F.lit("</"), "event_type", F.lit(">"))
    props = F.when(k % 2 == 0, F.concat(F.lit("<props><![CDATA[</event><x>"), "props", F.lit("]]></props>")))
    rec = F.concat(F.lit('<event id="'), ident, F.lit('"'), F.coalesce(note, F.lit("")), F.lit(">"), child, F.coalesce(props, F.lit("")), F.lit("<!-- <y/> --></event>"))
    xml = F.concat(F.lit('<?xml version="1.0"?><log><head/>'), rec, rec, F.lit("</log>"))
    return doc.xml_fields(table(spark, sf, "events").select("event_id", xml.alias("x")), "event_id", "x")


def api_documents(spark, sf):
    """A description per brand, of version 2 or 3 by turns: tables, columns and operations are those of its parts."""
    part = table(spark, sf, "part")
    n, hi = F.col("n") % 3, F.col("hi").cast("string")
    column = F.struct(
        F.when(n == 0, "integer").when(n == 1, "string").alias("type"),
        F.when(n == 1, F.concat(F.lit("size"), hi)).alias("format"),
        F.when(F.col("hi") > 20, F.concat("p_name", F.lit("\nup to "), hi)).alias("description"),
    )
    cols = part.groupBy("p_brand", "p_type", "p_name").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("hi"), F.min("p_size").alias("lo"))
    tables = cols.groupBy("p_brand", "p_type").agg(
        F.collect_list(F.when(F.col("lo") <= 10, F.col("p_name"))).alias("required"), F.map_from_entries(F.collect_list(F.struct("p_name", column.alias("c")))).alias("properties")
    )
    schemas = tables.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", F.struct("required", "properties").alias("t")))).alias("schemas"))
    method = F.element_at(F.array(*map(F.lit, ("get", "post", "PUT", "patch", "delete", "head", "parameters", "trace"))), F.col("p_size") % 8 + 1)
    ops = part.groupBy("p_brand", "p_type", method.alias("method")).agg(F.min("p_name").alias("summary"), F.count(F.lit(1)).alias("n"), F.max("p_partkey").cast("string").alias("k"))
    op = F.struct("summary", F.when(F.col("n") > 2, F.concat(F.lit("op"), "k")).alias("operationId"))
    paths = ops.groupBy("p_brand", F.concat(F.lit("/"), "p_type").alias("path")).agg(F.map_from_entries(F.collect_list(F.struct("method", op.alias("o")))).alias("m"))
    paths = paths.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("path", "m"))).alias("paths"))
    both = schemas.join(paths, "p_brand")
    v2 = F.to_json(F.struct(F.col("schemas").alias("definitions"), "paths"))
    v3 = F.to_json(F.struct(F.struct("schemas").alias("components"), "paths"))
    return both.select(F.col("p_brand").alias("api"), F.when(F.length("p_brand") % 2 == 0, v2).otherwise(v3).alias("doc"))


@query(
    "api_columns",
    "I12 I13",
    """WITH c AS (SELECT p_brand AS api, p_type AS "table", p_name AS "column", count(*) % 3 AS n, max(p_size) AS hi, min(p_size) AS lo FROM part GROUP BY 1, 2, 3)
SELECT api, "table", "column", CASE n WHEN 0 THEN 'integer' WHEN 1 THEN 'string' ELSE '' END AS type, CASE WHEN n = 1 THEN 'size' || hi ELSE '' END AS format,
lo <= 10 AS required, CASE WHEN hi > 20 THEN "column" || ' up to ' || hi ELSE '' END AS description FROM c""",
)
def api_columns(spark, sf):
    return doc.api_columns(doc.api_schemas(api_documents(spark, sf), "api", "doc"), "api")


@query(
    "api_operations",
    "I14",
    """WITH o AS (SELECT p_brand AS api, '/' || p_type AS path, p_size % 8 AS m, min(p_name) AS summary, count(*) AS n, max(p_partkey) AS k FROM part GROUP BY 1, 2, 3)
SELECT api, ['GET', 'POST', 'PUT', 'PATCH', 'DELETE', 'HEAD'][m + 1] AS method, path, summary, CASE WHEN n > 2 THEN 'op' || k ELSE '' END AS operation_id FROM o WHERE m < 6""",
)
def api_operations(spark, sf):
    return doc.api_operations(api_documents(spark, sf), "api", "doc")
