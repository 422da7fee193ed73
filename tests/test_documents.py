import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import composition as comp
from tidemark.operators import documents as doc
from tidemark.operators import inventory as inv
from tidemark.operators import linkage as lk


def test_urls(spark):
    df = spark.createDataFrame(
        [(" https://Host.EE/a%20b/?q=1#x ",), ("http://h.org//",), ("https://h/100%",), ("https://h/a+b%2Fc/",), ("plain",)], "u string"
    )
    got = [r[0] for r in df.select(inv.norm_page("u")).collect()]
    assert got == ["https://host.ee/a b", "http://h.org", "https://h/100%", "https://h/a+b/c", "://plain"]
    v = spark.createDataFrame(
        [("https://x.tableau.com/views/Book/My%20View?a=1",), ("https://t/static/images/ab/Bk/Vw/1.png",), ("https://t/viz/B/V",), ("https://t/shared/ID1?x",), ("https://t/other",)], "u string"
    )
    book, view = inv.workbook_view("u")
    assert [tuple(r) for r in v.select(book, view).collect()] == [("Book", "My View"), ("Bk", "Vw"), ("B", "V"), ("ID1", ""), ("", "")]
    h = spark.createDataFrame([("app.powerbi.com",), ("x.tableau.org",), ("own.server",), ("else",)], "h string")
    tech = inv.technology("h", {"own.server": "Own"})
    rows = h.select(tech.alias("t")).withColumn("o", inv.owner("t", [("Tableau", "we"), ("Own", "we")])).collect()
    assert [tuple(r) for r in rows] == [("Power BI", "unknown"), ("Tableau", "we"), ("Own", "we"), ("other", "unknown")]


def test_links_of_pages(spark):
    html = '<a href="https://public.tableau.com/views/A/B">x</a><iframe src="https://app.powerbi.com/q"></iframe><img src="https://tableau.x/logo.png"><img src="https://tableau.x/static/images/ab/W/V/1.png"><script src="/s.js"></script>'
    pages = spark.createDataFrame([("p", html)], "page_url string, html string")
    links = inv.page_links(pages, "page_url", "html")
    assert links.count() == 5
    got = {(r["kind"], r["workbook"], r["view"]) for r in inv.link_rows(links.union(links)).collect()}
    assert got == {("link", "A", "B"), ("iframe", "", ""), ("img", "W", "V")}


def test_links_in_any_writing(spark):
    html = (
        "<A HREF='x.html'><a href=y><a class=\"k\" href=\"z?a=1&amp;b=2\"><a href=\"&#x2f;up&#47;../t\"><a href='#top'><a href='?q=1'><a href='//o.org/p'><a data-href='no'><a href=''>"
        "<iframe src=\"https://f.org/a\" data-src='../late'></iframe><IMG data-src='no' SRC=pic.png>"
    )
    pages = spark.createDataFrame([("https://h.org/d/e/page?s=1#f", html), ("u", None)], "url string, html string")
    raw = [(r["kind"], r["src"]) for r in inv.page_links(pages, "url", "html").collect()]
    assert sorted(raw) == sorted(
        [("link", s) for s in ("x.html", "y", "z?a=1&b=2", "/up/../t", "#top", "?q=1", "//o.org/p")] + [("iframe", "https://f.org/a"), ("iframe", "../late"), ("img", "pic.png")]
    )
    full = {r["src"] for r in inv.page_links(pages, "url", "html", "url").collect()}
    assert full == {
        "https://h.org/d/e/x.html", "https://h.org/d/e/y", "https://h.org/d/e/z?a=1&b=2", "https://h.org/t", "https://h.org/d/e/page?s=1#top", "https://h.org/d/e/page?q=1", "https://o.org/p",
        "https://f.org/a", "https://h.org/d/late", "https://h.org/d/e/pic.png",
    }
    heads = spark.createDataFrame([("p", "<H1> </H1><h2>a&nbsp;&lt;b&#62;</h2><title></title>")], "id string, html string")
    assert [(r["tag"], r["text"]) for r in doc.page_outline(heads, "id", "html").collect()] == [("title", ""), ("h2", "a <b>")]


def test_inventory_merge_keeps_every_baseline_row(spark):
    inv_cols = "group string, page_url string, host string, workbook string, view string, title string"
    base = spark.createDataFrame(
        [("g", "https://p.ee/a/", "T.com", "Book", "View", "t1"), ("g", "https://p.ee/a", "t.com", "BOOK", "view", "t2"), ("g", "https://p.ee/b", "t.com", "Gone", "(unidentified)", "t3")], inv_cols
    )
    crawl = spark.createDataFrame(
        [("https://P.ee/a?x=1", "iframe", "t.com", "book", "VIEW", "s1"), ("https://p.ee/c", "iframe", "t.com", "New", "", "s2"), ("https://p.ee/c", "img", "t.com", "new", "", "s3"), ("https://p.ee/d", "link", "t.com", "L", "L", "s4")],
        "page_url string, kind string, host string, workbook string, view string, src string",
    )
    listing = spark.createDataFrame([("view", "P", "Book/sheets/View", "View", "Book"), ("view", "P", "Other/sheets/X/Y", "n", "w"), ("workbook", "P", "z", "z", "z")], "type string, project string, content_url string, name string, workbook string")
    out = inv.merge_inventory(base, crawl, inv.server_rows(listing, "t.com")).collect()
    got = sorted((r["origin"], r["workbook"], r["view"], r["found"]) for r in out)
    assert got == [
        ("crawl", "New", "(unidentified)", "yes"),
        ("inventory", "BOOK", "view", "yes"),
        ("inventory", "Book", "View", "yes"),
        ("inventory", "Gone", "(unidentified)", "no"),
        ("server", "Other", "X/Y", ""),
    ]
    assert {r["found"] for r in inv.merge_inventory(base, None, None).collect()} == {""}


def test_topics(spark):
    topics = spark.createDataFrame([("a", "G1", ["b", "zz"]), ("b", "G2", None)], "slug string, group string, related array<string>")
    items = spark.createDataFrame([("G1", "pub"), ("G1", "other"), ("G9", "pub")], "group string, host string")
    out = inv.attach_topics(topics, items, "pub")
    assert [r["to"] for r in out["dangling"].collect()] == ["zz"]
    assert [r["group"] for r in out["unmatched_groups"].collect()] == ["G9"]
    assert [r["slug"] for r in out["without_views"].collect()] == ["b"] and out["other_hosts"].count() == 1
    with pytest.raises(ValueError, match="zz"):
        lk.require_empty(out["dangling"], "unknown related topics", ["slug", "to"])
    s = comp.status_summary(spark.createDataFrame([("t", "done", 5), ("t", "none", 15), ("u", "none", 0)], "g string, s string, w int"), "g", "s", "w", ["done", "none"], "none")
    got = {r["g"]: (r["n"], r["weight"], r["share_uncovered"]) for r in s.collect()}
    assert got == {"t": (2, 20, 0.75), "u": (1, 0, None), None: (3, 20, 0.75)}


def test_captions_and_tags(spark):
    text = "Joonis 1. Raie maht aastatel 2000-2010 maakonniti\nFigure 1. Felling by county over years\nTabel 2: Metsamaa pindala jaotus ja viga\nlause\nJoonis 3. Lühike"
    docs = spark.createDataFrame([("et", text), ("en", "Figure 2. Share of forest land\nTable 1. Error of the increment")], "id string, text string")
    caps = doc.captions(docs, ["id"], "text")
    assert caps.where("id = 'et'").count() == 4
    far = spark.createDataFrame([("x", "Joonis 1. " + "a" * 200 + " pindala")], "id string, text string")
    assert doc.captions(far, ["id"], "text").first()["text"].endswith("pindala") and len(doc.captions(far, ["id"], "text", width=160).first()["text"]) == 160
    native = {(r["id"], r["label"]) for r in doc.native_captions(caps, "id").collect()}
    assert native == {("et", "joonis"), ("et", "tabel"), ("en", "figure"), ("en", "table")}
    pages = spark.createDataFrame([("et", 50), ("en", None)], "id string, pages int")
    summary, tags = doc.classify_captions(caps, "id", pages)
    s = {(r["id"], r["kind"]): r for r in summary.collect()}
    assert s[("et", "figures")]["n"] == 1 and s[("et", "figures")]["per_100_pages"] == 2.0  # the short caption does not count
    assert s[("et", "tables")]["caption_mentions_uncertainty"] == 1 and s[("en", "figures")]["per_100_pages"] is None
    t = {(r["id"], r["kind"], r["family"], r["tag"]): r["n"] for r in tags.collect()}
    assert t[("et", "figures", "forms", "time")] == 1 and t[("et", "figures", "dimensions", "geography")] == 1
    assert t[("et", "figures", "themes", "felling")] == 1 and t[("et", "tables", "forms", "composition")] == 1
    total = doc.caption_totals(tags, "id").where("all_documents = 1 and kind = 'figures' and family = 'forms' and tag = 'composition'").first()
    assert total["n"] == 1


def test_keyword_context(spark):
    long = "x" * 100 + " the Confidence level " + "y" * 200 + " confidence again"
    df = spark.createDataFrame([("d", 1, long), ("d", 2, "a\n confidence"), ("d", 3, "nothing")], "doc string, page int, text string")
    got = sorted((r["page"], r["word"], len(r["context"])) for r in doc.keyword_context(df, "doc", "page", "text", r"(?i)confidence\w*").collect())
    assert got == [(1, "confidence", 70 + 10 + 90), (2, "confidence", 12)]
    hits = doc.keyword_context(df, "doc", "page", "text", r"(?i)confidence\w*")
    assert doc.keyword_pages(hits, "doc", "page").first()["keyword_pages"] == 2
    many = spark.range(60).select(F.lit("d").alias("doc"), F.col("id").alias("page"), F.lit("confidence").alias("text"))
    assert doc.keyword_context(many, "doc", "page", "text", "confidence").count() == 60
    assert doc.keyword_context(many, "doc", "page", "text", "confidence", per_document=40).count() == 40


def test_html_json_xml(spark):
    html = "<html><title> A &amp; B </title><h1>Top <b>x</b></h1><h3>c</h3><h2>b</h2><a href='q'></a><a href=\"f.PDF?x=1\">p</a><a href=\"f.html\">p</a></html>"
    df = spark.createDataFrame([("p", html)], "id string, html string")
    assert [(r["tag"], r["text"]) for r in doc.page_outline(df, "id", "html").collect()] == [("title", "A & B"), ("h1", "Top x"), ("h2", "b"), ("h3", "c")]
    assert [r["href"] for r in doc.links_with_suffix(df, "id", "html").collect()] == ["f.PDF?x=1"]

    payload = {"data": [{"a": 1, "b": 1.5, "c": "x", "d": [1], "e": {"z": 1}, "f": None, "g": True}], "meta": 1}
    js = spark.createDataFrame([("j", json.dumps(payload)), ("l", json.dumps([{"q": "1"}])), ("e", "[]"), ("o", json.dumps({"k": 2}))], "id string, js string")
    got = {(r["id"], r["field"]): r["type"] for r in doc.json_fields(js, ["id"], "js").collect()}
    assert got == {
        ("j", "a"): "integer", ("j", "b"): "number", ("j", "c"): "string", ("j", "d"): "array", ("j", "e"): "object", ("j", "f"): "null", ("j", "g"): "boolean",
        ("l", "q"): "string", ("o", "k"): "integer",
    }
    nested = {"x": [{"fieldCaption": "Area \"ha\""}, {"y": {"sheetName": "S1", "fieldCaption": " "}}], "repo": {"repoUrl": "u1", "in": [{"repoUrl": "u2"}]}}
    n = spark.createDataFrame([("n", json.dumps(nested))], "id string, js string")
    names = {(r["kind"], r["name"]) for r in doc.nested_values(n, "id", "js", {"fieldCaption": "field", "sheetName": "sheet"}).collect()}
    assert names == {("field", 'Area "ha"'), ("sheet", "S1")}
    recs = [json.loads(r["record"]) for r in doc.records_with_key(n, "id", "js", "repoUrl").collect()]
    assert sorted(r["repoUrl"] for r in recs) == ["u1", "u2"]

    xml = "<?xml version='1.0'?><r><head/><!-- <rec/> --><rec id='1' k=\"2\"><a>1</a><b><c/></b></rec><rec><z/></rec></r>"
    x = spark.createDataFrame([("x", xml)], "id string, xml string")
    got = {(r["field"], r["type"]) for r in doc.xml_fields(x, "id", "xml").collect()}
    assert got == {("@id", "attribute"), ("@k", "attribute"), ("a", "element"), ("b", "element")}


def test_api_descriptions(spark):
    v2 = {"definitions": {"t": {"description": "T", "required": ["a"], "properties": {"a": {"type": "integer", "description": "x\ny"}, "b": {"format": "date"}}}, "n": {"type": "string"}}, "paths": {"/t": {"get": {"summary": "s", "operationId": "o"}, "parameters": []}}}
    v3 = {"components": {"schemas": {"u": {"properties": {"q": {"type": "string"}}}}}}
    df = spark.createDataFrame([("2", json.dumps(v2)), ("3", json.dumps(v3))], "api string, doc string")
    tables = doc.api_schemas(df, "api", "doc")
    assert {(r["api"], r["table"], r["n_columns"]) for r in tables.collect()} == {("2", "t", 2), ("3", "u", 1)}
    cols = {r["column"]: r for r in doc.api_columns(tables, "api").collect()}
    assert cols["a"]["required"] and cols["a"]["description"] == "x y" and not cols["b"]["required"] and cols["b"]["format"] == "date"
    assert [tuple(r) for r in doc.api_operations(df, "api", "doc").collect()] == [("2", "GET", "/t", "s", "o")]


def test_links_are_read_tag_by_tag(spark):
    html = (
        "<a title='a>b' href='y'>1</a><!-- <a href=x> --><script>var s = '<a href=\"no\">'; if (a < b) {}</script><a data-x=\" href='no' \" href=plain/z>"
        "<STYLE>a:after{content:'<a href=css>'}</STYLE><A\nHREF = \"up\"  href='second'><a title=it's href='q'><abbr href='no'><script src='s.js'>x</script>"
        "<a href><a =href=odd><a href=\"&#38;lt;&amp;gt;&lt;&#x41;&nope;&\"><img alt=\"<a href='no'>\" src=i.png><a href='open>z<!-- <a href='cut'>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<a " + "x='1' " * 50_000 + "href='far'>" + "&amp;" * 50_000)], "page int, html string")
    got = {}
    for r in inv.page_links(pages, "page", "html").collect():
        got.setdefault(r["page"], []).append((r["kind"], r["src"]))
    # a name may begin with a sign; the value left open runs to the next quote, as a browser reads it
    assert [s for k, s in got[1] if k == "link"] == ["y", "plain/z", "up", "q", "&lt;&gt;<A&nope;&", "open>z<!-- <a href="]
    assert ("script", "s.js") in got[1] and ("img", "i.png") in got[1] and not {"no", "x", "css", "second"} & {s for _, s in got[1]}
    assert got[4] == [("link", "far")] and set(got) == {1, 4}


def test_references_are_decoded_once(spark):
    rows = [("&#38;lt;", "&lt;"), ("&amp;amp;", "&amp;"), ("a&b;&#0;&#xD800;", "a&b;&#0;&#xD800;"), ("&#228;&#xE4;&lt;p&gt;", "ää<p>"), ("&;&&lt;", "&;&<"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert df.where(~inv.unescaped("t").eqNullSafe(df["want"])).count() == 0


def holders(node, key):
    """Objects that hold a key, by walking the parsed document."""
    kids = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
    return ([node] if isinstance(node, dict) and key in node else []) + [h for k in kids for h in holders(k, key)]


def test_records_with_key_at_any_depth(spark):
    deep = {"repo": 0}
    for i in range(1, 90):
        deep = {"repo": i, "in": [deep, {"no": "} ] {"}]} if i % 2 else [{"x": "\\\"repo\\\": {", "y": deep}, []]
    wide = {"items": [{"repo": i, "s": "a\\" * (i % 3), "t": {"repo": None} if i % 7 == 0 else i} for i in range(2_000)]}
    long = {"a": {"repo": "\"[{" * 60_000}}
    docs = [deep, wide, long, {"re": {"po": 1}}, ["repo", {"k": "repo"}], {"repo": {"repo": {"repo": []}}}, {}, [], 7, "repo"]
    rows = [(i, json.dumps(d, indent=1 if i % 2 else None)) for i, d in enumerate(docs)]
    rows += [(90, None), (91, ""), (92, '{"repo": 1'), (93, '"repo": 1}'), (94, '{"r\\u0065po" : 1}'), (95, '{"repo":1,"repo":2}'), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "id int, js string")
    out = doc.records_with_key(df, "id", "js", "repo")
    got = {}
    for r in out.collect():
        got.setdefault(r["id"], []).append(json.dumps(json.loads(r["record"])))
    for i, d in enumerate(docs):
        want = [json.dumps(h) for h in holders(d, "repo")] * (2 if i == 5 else 1)
        assert sorted(got.get(i, [])) == sorted(want), i
    assert {i: len(g) for i, g in got.items() if i >= 90} == {94: 1, 95: 1}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_xml_fields_with_character_data_and_signs_in_values(spark):
    xml = (
        "<!DOCTYPE r><r v='<!--'><rec k='a>b c=\"1\"' õ:d = \"it's <![CDATA[\"><a t='/>'>1 &gt; 0</a><![CDATA[</rec><no/>]]><b/><!-- <c/> --></rec><rec/><?pi <d/> ?></r>"
    )
    rows = [("x", xml), ("n", None), ("e", ""), ("t", "no tags > here <"), ("o", "<r/>"), ("l", "<r><rec><z>" + "<![CDATA[<]]>" * 20_000 + "</z></rec></r>")]
    got = {}
    for r in doc.xml_fields(spark.createDataFrame(rows, "id string, xml string"), "id", "xml").collect():
        got.setdefault(r["id"], set()).add(r["field"])
    assert got == {"x": {"@k", "@õ:d", "a", "b"}, "l": {"z"}}
