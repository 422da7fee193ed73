"""URL parsing and the merge of a hand-kept inventory with crawled and server-side listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, any_of, col, let
from tidemark.functions.ranks import earliest

#: Platform hosts (a part of the host name) and their labels, first match wins.
PLATFORMS: Sequence[tuple[str, str]] = (
    ("tableau", "Tableau"),
    ("powerbi.com", "Power BI"),
    ("arcgis.com", "ArcGIS"),
    ("arcg.is", "ArcGIS"),
    ("storymaps", "ArcGIS"),
)
#: Link patterns that carry a workbook and a view, in order; a shared link carries only an id.
VIEW_PATTERNS = (r"/views/([^/?#]+)/([^/?#]+)", r"/static/images/[^/]+/([^/]+)/([^/]+)/", r"/viz/([^/?#]+)/([^/?#]+)")
SHARED_PATTERN = r"/shared/([^/?#]+)"
EMBED_KINDS = ("tableau-viz", "iframe", "img")
URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def decoded(url: ColumnLike) -> Column:
    """Percent-decoded text (a plus sign stays a plus sign; text that cannot be decoded stays as it is)."""
    u = F.trim(col(url))
    return F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u)


def host_of(url: ColumnLike) -> Column:
    return F.regexp_extract(col(url), URL, 2)


def path_of(url: ColumnLike) -> Column:
    return F.regexp_extract(col(url), URL, 3)


def norm_page(url: ColumnLike) -> Column:
    """Decoded URL without query and fragment, lower-case host, no trailing slash."""
    u = decoded(url)
    path = F.regexp_replace(F.regexp_extract(u, URL, 3), r"/+$", "")
    return F.concat(F.lower(F.regexp_extract(u, URL, 1)), F.lit("://"), F.lower(F.regexp_extract(u, URL, 2)), path)


def technology(host: ColumnLike, exact: Mapping[str, str] | None = None, platforms=PLATFORMS, other: str = "other") -> Column:
    """Host to platform label: exact hosts first, then the first platform contained in the host."""
    h = F.lower(col(host))
    rules = [(h == k, v) for k, v in (exact or {}).items()] + [(h.contains(k), v) for k, v in platforms]
    out = F.when(*_rule(rules[0]))
    for rule in rules[1:]:
        out = out.when(*_rule(rule))
    return out.otherwise(other)


def _rule(rule: tuple[Column, str]) -> tuple[Column, Column]:
    return rule[0], F.lit(rule[1])


def owner(tech: ColumnLike, owners: Sequence[tuple[str, str]], unknown: str = "unknown") -> Column:
    """Owner of the first label prefix that fits."""
    out = F.lit(unknown)
    for prefix, name in reversed(owners):
        out = F.when(col(tech).startswith(prefix), name).otherwise(out)
    return out


def is_platform(url: ColumnLike, platforms=PLATFORMS) -> Column:
    host = F.lower(host_of(url))
    return any_of(host.contains(k) for k, _ in platforms)


def workbook_view(url: ColumnLike) -> tuple[Column, Column]:
    """Workbook and view from a link; the id of a shared link counts as its workbook; else empty."""
    path = decoded(path_of(url))
    books = [F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in VIEW_PATTERNS]
    views = [F.nullif(F.regexp_extract(path, p, 2), F.lit("")) for p in VIEW_PATTERNS]
    shared = F.nullif(F.regexp_extract(path, SHARED_PATTERN, 1), F.lit(""))
    return F.coalesce(*books, shared, F.lit("")), F.coalesce(*views, F.lit(""))


def link_rows(links: DataFrame, page: str = "page_url", kind: str = "kind", src: str = "src") -> DataFrame:
    """Distinct platform links of pages with host, workbook and view; images only when they show a view."""
    book, view = workbook_view(src)
    keep = is_platform(src) & ((F.col(kind) != "img") | F.col(src).contains("/static/images/"))
    return links.where(keep).select(page, kind, src).distinct().withColumns(
        {"host": host_of(src), "workbook": book, "view": view}
    )


#: one quoted or plain value; possessive, so that long values need no stack
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
#: comments with what they hold, and start tags; what scripts and styles hold goes with their tag (group 3 is empty and marks them)
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|(<(?:(script|style)(?=[\s/>])()|[a-z][^\s/>]*+)(?:[^>=]*+=\s*+{VALUE})*+[^>=]*+>)(?:\3.*?(?:</\2|\z))?+"
)
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-z]{2,4});|[^&]++|&"
#: Named character references.
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\xa0", "amp": "&"}


def unescaped(text: ColumnLike) -> Column:
    """Numbered and the common named character references as characters; others stay.  What a reference gives is not read again."""

    def character(ref: Column) -> Column:
        body = F.substring(ref, F.lit(2), F.length(ref) - 2)
        out = F.when(body.rlike("^#[0-9]"), F.conv(F.substr(body, F.lit(2)), 10, 10)).otherwise(F.conv(F.substr(body, F.lit(3)), 16, 10))
        code = out.cast("bigint")
        fits = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        plain = F.when(body.startswith("#") & fits, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        for name, char in NAMED.items():
            plain = plain.when(body == name, char)
        return F.when((F.length(ref) > 3) & ref.startswith("&") & ref.endswith(";"), plain.otherwise(ref)).otherwise(ref)

    t = col(text)
    pieces = F.regexp_extract_all(t, F.lit(f"({REFERENCE})"), 1)
    return F.when(t.contains("&"), F.array_join(F.transform(pieces, character), "")).otherwise(t)


def start_tags(html: ColumnLike) -> Column:
    """All start tags of a page in order, whole: quoted values may hold ``>``; comments, scripts and styles hold no tags."""
    return F.filter(F.regexp_extract_all(col(html), F.lit(MARKUP), 1), lambda t: t != "")


def tag_values(tags: Column, tag: str, name: str) -> Column:
    """Non-blank values of an attribute in the start tags of a kind, unescaped; the first of a tag counts.

    Attributes are read one after another from the tag's beginning, so a name inside another's value is none.
    """
    step = rf"(?is)\G[\s/]*+(?:{name}(?=[\s=])\s*+=\s*+({VALUE})|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE})?+)"
    of_kind = F.filter(tags, lambda t: t.rlike(rf"(?i)^<{tag}[\s/>]"))
    first = F.transform(of_kind, lambda t: F.try_element_at(F.filter(F.regexp_extract_all(t, F.lit(step), 1), lambda v: v != ""), F.lit(1)))
    plain = F.transform(first, lambda v: F.trim(unescaped(F.regexp_replace(v, r"""(?s)^(["'])(.*)\1$|^["']""", "$2"))))
    return F.filter(plain, lambda v: v != "")


def attribute_values(html: ColumnLike, tag: str, name: str) -> Column:
    """Non-blank values of an attribute in all tags of a kind: any case, quoted either way or not at all, unescaped."""
    return tag_values(start_tags(html), tag, name)


def absolute(src: ColumnLike, base: ColumnLike) -> Column:
    """A link target as the page at ``base`` means it; steps up and ``./`` are resolved."""
    s, scheme, host, path = col(src), F.regexp_extract(col(base), URL, 1), host_of(base), path_of(base)
    root = F.concat(scheme, F.lit("://"), host)
    tail = F.regexp_extract(s, r"^[^?#]*(.*)$", 1)
    joined = F.concat(F.regexp_replace(path, r"[^/]*$", ""), F.regexp_extract(s, r"^([^?#]*)", 1))
    full = F.when(s.startswith("/"), F.regexp_extract(s, r"^([^?#]*)", 1)).otherwise(F.regexp_replace(joined, r"^(?!/)", "/"))

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    # a last step that names a folder keeps its slash
    parts = F.split(F.regexp_replace(full, r"/\.\.?$", "$0/"), "/")
    clean = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    return (
        F.when(s.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), s)
        .when(s.startswith("//"), F.concat(scheme, F.lit(":"), s))
        .when(s.startswith("#"), F.concat(F.regexp_replace(col(base), r"#.*$", ""), s))
        .when(s.startswith("?"), F.concat(root, path, s))
        .otherwise(F.concat(root, clean, tail))
    )


def page_links(pages: DataFrame, ident: str, html: str, base: str | None = None) -> DataFrame:
    """``(ident, kind, src)`` of every link and embed in the page source; lazy frames keep theirs in ``data-src``.

    With ``base``, the column of the page's own URL, targets are absolute.
    """
    rules = (
        ("tableau-viz", "tableau-viz", "src"),
        ("iframe", "iframe", "src"),
        ("iframe", "iframe", "data-src"),
        ("img", "img", "src"),
        ("link", "a", "href"),
        ("script", "script", "src"),
    )

    def of_kind(tags: Column, kind: str, tag: str, name: str) -> Column:
        return F.transform(tag_values(tags, tag, name), lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("src")))

    # tags are found once for all kinds
    found = let(start_tags(html), lambda tags: F.flatten(F.array(*[of_kind(tags, *rule) for rule in rules])))
    kept = [ident, *([base] if base and base != ident else [])]
    rows = pages.select(*kept, F.explode(found).alias("x")).select(*kept, "x.kind", "x.src")
    return rows.select(ident, "kind", (absolute("src", base) if base else F.col("src")).alias("src"))


def match_key(page: ColumnLike, host: ColumnLike, workbook: ColumnLike, view: ColumnLike, placeholder: str) -> dict[str, Column]:
    """Case-folded key columns; a placeholder view counts as empty."""
    text = {k: F.coalesce(F.trim(col(c)), F.lit("")) for k, c in (("host", host), ("workbook", workbook), ("view", view))}
    seen = F.when(text["view"] == placeholder, "").otherwise(text["view"])
    return {
        "k_page": norm_page(F.coalesce(col(page), F.lit(""))),
        "k_host": F.lower(text["host"]),
        "k_book": F.lower(text["workbook"]),
        "k_view": F.lower(seen),
    }


KEYS = ("k_page", "k_host", "k_book", "k_view")


def server_rows(listing: DataFrame, host: str, group: str = "server") -> DataFrame:
    """Server-side view records as inventory rows; ``Workbook/sheets/View`` is split at the first mark."""
    at = F.instr("content_url", "/sheets/")
    has = at > 0
    wb = F.when(has, F.expr("substring(content_url, 1, instr(content_url, '/sheets/') - 1)")).otherwise(F.coalesce("workbook", F.lit("")))
    vw = F.when(has, F.expr("substring(content_url, instr(content_url, '/sheets/') + 8)")).otherwise(F.lit(""))
    return listing.where(F.col("type") == "view").select(
        F.regexp_replace(F.concat(F.lit(group + ": "), F.coalesce("project", F.lit(""))), r"[: ]+$", "").alias("group"),
        F.lit("").alias("page_url"),
        F.lit(host).alias("host"),
        wb.alias("workbook"),
        F.when(vw == "", F.coalesce("name", F.lit(""))).otherwise(vw).alias("view"),
        F.coalesce("name", F.lit("")).alias("title"),
    )


def merge_inventory(
    baseline: DataFrame,
    crawled: DataFrame | None,
    server: DataFrame | None,
    placeholder: str = "(unidentified)",
    crawl_group: str = "crawl",
) -> DataFrame:
    """Baseline rows (never dropped, with a found flag), rows only the crawl found, rows only the server has."""
    cols = ["group", "page_url", "host", "workbook", "view", "title"]
    key = match_key("page_url", "host", "workbook", "view", placeholder)
    base = baseline.withColumns(key)
    out = None
    if crawled is not None:
        embeds = crawled.where(F.col("kind").isin(*EMBED_KINDS) & (F.col("host") != "")).withColumns(key)
        once = earliest(embeds, KEYS, ["src"], ["page_url", "host", "workbook", "view"])
        flag = once.select(*KEYS).withColumn("__hit", F.lit(True))
        out = base.join(flag, list(KEYS), "left").select(
            *cols, F.lit("inventory").alias("origin"), F.when(F.col("__hit"), "yes").otherwise("no").alias("found")
        )
        fresh = once.join(base.select(*KEYS).distinct(), list(KEYS), "left_anti")
        out = out.unionByName(
            fresh.select(
                F.lit(crawl_group).alias("group"),
                "page_url",
                "host",
                "workbook",
                F.when(F.col("view") == "", placeholder).otherwise(F.col("view")).alias("view"),
                F.lit("").alias("title"),
                F.lit("crawl").alias("origin"),
                F.lit("yes").alias("found"),
            )
        )
    else:
        out = base.select(*cols, F.lit("inventory").alias("origin"), F.lit("").alias("found"))
    if server is not None:
        view_keys = ["k_host", "k_book", "k_view"]
        extra = server.withColumns(key).join(base.select(*view_keys).distinct(), view_keys, "left_anti")
        out = out.unionByName(extra.select(*cols, F.lit("server").alias("origin"), F.lit("").alias("found")))
    return out


def distinct_views(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct (host, workbook, view) over several listings, complete ones only."""
    out = None
    for f in frames:
        part = f.select("host", "workbook", "view")
        out = part if out is None else out.unionByName(part)
    return out.where((F.col("host") != "") & (F.col("workbook") != "") & (F.col("view") != "")).distinct()


def attach_topics(topics: DataFrame, inventory: DataFrame, host: str) -> dict[str, DataFrame]:
    """Topic metadata with its inventory views, and the checks: dangling related slugs, groups without a
    topic, views on other hosts, topics without views."""
    j = topics.join(inventory.where(F.col("host") == host), "group", "left")
    related = topics.select("slug", F.explode_outer("related").alias("to")).where(F.col("to").isNotNull())
    return {
        "topics": j,
        "dangling": related.join(topics.select(F.col("slug").alias("to")), "to", "left_anti"),
        "unmatched_groups": inventory.join(topics.select("group"), "group", "left_anti").select("group").distinct(),
        "other_hosts": inventory.join(topics.select("group"), "group", "left_semi").where(F.col("host") != host),
        "without_views": topics.join(inventory.where(F.col("host") == host), "group", "left_anti").select("slug"),
    }
