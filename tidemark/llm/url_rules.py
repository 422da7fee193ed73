"""URL filters (10): rules indexed by their rarest literal token; only the rules a URL's tokens fetch run their pattern."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import map_arrow, pick

#: rules whose index goes to the tasks at one time; longer lists pass block by block
BLOCK_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and paths that begin with ``path``; ``*`` stands for any run."""

    action: str
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.action not in ("allow", "block"):
            raise ValueError(f"action {self.action}")

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        host = "[^/]*".join(map(re.escape, self.host.split("*")))
        path = ".*".join(map(re.escape, self.path.split("*")))
        return f"(?s)(?:[^/]*\\.)?{host}/{path}"

    def tokens(self) -> set[str]:
        """Tokens that every URL the rule fits must have whole: host labels, path pieces that end inside the rule."""
        host = set(re.findall(r"[a-z0-9]+", self.host)) if "*" not in self.host else set()
        path = self.path.split("*")[0]
        return host | {m.group() for m in re.finditer(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", path)}


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(text, "[^a-z0-9]+"))


def _index(rules: list[tuple[int, Rule]], counts: dict[str, int]) -> tuple[dict[str, list], list]:
    """Rules by their rarest token, and those without a token; longest first, the earlier of equals first."""
    by_token: dict[str, list] = {}
    always: list = []
    for place, rule in sorted(rules, key=lambda r: (-len(r[1].text), r[0])):
        entry = (-len(rule.text), place, rule.text, rule.action, rule.pattern)
        tokens = sorted(rule.tokens(), key=lambda t: (counts.get(t, 0), t))
        (by_token.setdefault(tokens[0], []) if tokens else always).append(entry)
    return by_token, always


def judge(pages: DataFrame, rules: Iterable[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url", block_rules: int = BLOCK_RULES) -> DataFrame:
    """Judge every URL: ``(id, url, host, path, rule, verdict)``.

    A rule fits its host and all subdomains where the path starts with the rule's.  The longest rule wins; of equally
    long ones the earlier.  Tokens of all URLs are counted first, so that a rule stands under its rarest token.  A null
    URL, or one without ``://``, has an empty host and path and no rule; without a rule the verdict is ``default``.
    Null and repeated ids are kept as they are; rules beyond ``block_rules`` are tried block by block, and no list of
    rules or URLs is cut.
    """
    spark = pages.sparkSession
    urls = pick(pages, page_id=id_col, url=url_col).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    listed = list(enumerate(rules))
    wanted = spark.createDataFrame([(t,) for t in sorted({t for _, r in listed for t in r.tokens()})], "token string")
    seen = urls.select(F.explode(_tokens(F.concat_ws("/", "host", "path"))).alias("token")).groupBy("token").count()
    # as many rows at most as the rules have tokens
    counts = {r["token"]: r["count"] for r in seen.join(wanted, "token", "left_semi").toLocalIterator()}
    kind = urls.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, host string, path string, size int, place int, rule string, verdict string"
    out = urls.selectExpr("page_id", "url", "host", "path", "0 size", "0 place", "cast(null as string) rule", f"'{default}' verdict")
    for at in range(0, len(listed), block_rules):
        out = _try(out, spark.sparkContext.broadcast(_index(listed[at : at + block_rules], counts)), schema)
    return out.select("page_id", "url", "host", "path", "rule", "verdict")


def _try(urls: DataFrame, index, schema: str) -> DataFrame:
    def make():
        by_token, always = index.value
        compiled: dict[str, re.Pattern] = {}

        def fits(entry: tuple, target: str) -> bool:
            pattern = entry[4]
            if pattern not in compiled:
                compiled[pattern] = re.compile(pattern)
            return compiled[pattern].match(target) is not None

        def best(host: str, path: str, known: tuple) -> tuple:
            target = f"{host}/{path}"  # a host has no slash
            for entries in (*(by_token.get(t, ()) for t in set(re.findall(r"[a-z0-9]+", target))), always):
                for entry in entries:
                    if entry[:2] >= known[:2]:
                        break
                    if fits(entry, target):
                        known = entry[:4]
                        break
            return known

        def work(batch: pa.RecordBatch) -> dict:
            rows = zip(*(batch.column(c).to_pylist() for c in ("host", "path", "size", "place", "rule", "verdict")))
            found = [best(r[0], r[1], r[2:]) if r[0] else r[2:] for r in rows]
            size, place, rule, verdict = zip(*found)
            return {c: batch.column(c) for c in ("page_id", "url", "host", "path")} | {"size": size, "place": place, "rule": rule, "verdict": verdict}

        return work

    return map_arrow(urls, make, schema)
