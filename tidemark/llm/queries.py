"""Queries over the given tables, one for each operator; digests are derived here from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat_format, decontaminate, jaccard_join, order_minhash, periodic_runs, simhash_cover, token_counts, token_files, toxicity, turn_repair, url_rules, warc_zip
from tidemark.llm._common import staged

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
SQL: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def wrap(fn: Runner) -> Runner:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return found.withColumn("over_limit", F.col("n_tokens") > 512)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encoded and decoded documents as counts and digests."""
    read = bpe.round_trip(docs, path)
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op7_bpe_codec")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all documents."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    folder, files = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return token_files.checksums(folder, staged(files))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(list_slice(ws, pos, pos + least(10, len(ws)) - 1), ' ') AS gram
      FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS pos FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM g),
dg AS (SELECT doc_id, size, pos, array_to_string(list_slice(ws, pos, pos + size - 1), ' ') AS gram
       FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS pos FROM w, sizes WHERE len(ws) >= size)),
h AS (SELECT dg.doc_id, dg.pos, dg.size, g.item_id FROM dg JOIN g ON dg.size = g.size AND dg.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM h) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY 1)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test passages in all documents."""
    found = decontaminate.find_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )


def usable_for_training(doc_id: str = "doc_id") -> Column:
    """The fold that a model may learn from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 != 0


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable_for_training())
    found = toxicity.score(docs, model)
    return found.select("doc_id", (~usable_for_training()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: The list of the contract.
URL_RULES = (
    url_rules.Rule("allow", "com", "/"),
    url_rules.Rule("block", "example.com", "/en/"),
    url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"),
    url_rules.Rule("block", "net", "/fr/"),
)

OP10_SQL = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                     WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                     WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                     WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                     WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op10_url_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(list_slice(ws, pos, pos + 2), ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS pos FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS top FROM w UNION SELECT e.b, r.top FROM r JOIN e ON e.a = r.node WHERE r.top < e.b)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, t.top AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(top) AS top FROM r GROUP BY 1) t ON t.node = w.doc_id"""


@query("op5_jaccard_join", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return jaccard_join.link_groups(table(spark, sf_dir, "documents"), size=3, threshold="0.9")


@query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    texts = order_minhash.spliced(table(spark, sf_dir, "documents"))
    found = staged(
        texts.select(
            "doc_id", "next_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), order_minhash.sketch(F.col("text")).alias("own"), order_minhash.sketch(F.col("edited")).alias("cut")
        )
    )
    after = found.select(F.col("doc_id").alias("next_id"), F.col("own").alias("after"))
    return found.join(after, "next_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", order_minhash.fingerprint(F.col("own")).alias("fingerprint"), order_minhash.fingerprint(F.col("cut")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("own"), F.col("cut")).alias("near_edited"), F.coalesce(order_minhash.likeness(F.col("own"), F.col("after")), F.lit(0.0)).alias("near_next"),
    )


OP3_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (SELECT *, (octet_length(encode(text)) + 3) // 4 + 4 AS cost,
             24 + length(role) + length(text) + length(text) - length(replace(text, '\', ''))
             + len(regexp_extract_all(text, '<\|im_start\||<\|im_end\||<\|endoftext\||</?s>|<</?SYS>>|\[/?INST\]')) AS size FROM t),
p AS (SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS until,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM c),
w AS (SELECT *, (until - 1) // 768 AS win FROM p),
h AS (SELECT conv_id, size FROM w WHERE place = 1 AND role = 'system'),
own AS (SELECT conv_id, win, sum(size) AS size, min(place) AS place, min(until - cost) AS at FROM w GROUP BY 1, 2),
old AS (SELECT own.conv_id, own.win, sum(w.size) AS size FROM own JOIN w ON w.conv_id = own.conv_id AND w.place < own.place AND w.until - w.cost >= own.at - 256
        WHERE NOT (w.place = 1 AND w.role = 'system') GROUP BY 1, 2),
f AS (SELECT own.conv_id, CAST(sum(own.size + coalesce(old.size, 0) + CASE WHEN own.place > 1 THEN coalesce(h.size, 0) ELSE 0 END) AS BIGINT) AS formatted_chars
      FROM own LEFT JOIN old USING (conv_id, win) LEFT JOIN h USING (conv_id) GROUP BY 1)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM t JOIN f USING (conv_id) GROUP BY conv_id"""


@query("op3_chat_format", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as windows, read back."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], talk.schema)
    return chat_format.digests(chat_format.read_windows(chat_format.format_windows(talk.unionByName(added))))


OP4_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS target FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN target = page_id THEN 'response' ELSE 'revisit' END AS record_type, nullif(target, page_id) AS refers_to FROM m"""


@query("op4_warc_zip", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in ZIP packages, read back; responses are measured anew, revisits say what they stand for."""
    folder, files = warc_zip.write_packages(table(spark, sf_dir, "pages"))
    read = warc_zip.read_records(folder, warc_zip.locate(folder, files))
    own = F.col("kind") == "response"
    return read.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def crc32_sql(text: str) -> str:
    """The checksum of an ASCII text in DuckDB: a byte goes in, eight steps of the shift register follow."""
    steps = f"list_concat([4294967295], flatten(list_transform(range(1, length({text}) + 1), lambda i: [unicode(substr({text}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1])))"
    return f"xor(list_reduce({steps}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
c AS (SELECT doc_id, ws, h % 10 = 0 AND len(ws) > 0 AS hit, (h // 10) % greatest(len(ws), 1) AS a, (h // 10) % 8 AS g FROM d),
e AS (SELECT doc_id, CASE WHEN hit THEN list_transform(range(0, len(ws)), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(ws) - a) // (3 + g)) END]) ELSE ws END AS ws FROM c),
w AS (SELECT doc_id, len(ws) AS n, unnest(range(0, len(ws))) AS i, unnest(ws) AS word FROM e),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
s AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q AS period FROM k GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s t WHERE t.doc_id = s.doc_id AND t.period < s.period AND t.start <= s.start AND s.start + s.length <= t.start + t.length)),
o AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed, min({{'l': -length, 's': start, 'p': period}}) AS best FROM r GROUP BY 1),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
l AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN x USING (doc_id, i) GROUP BY 1)
SELECT e.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(-best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
       CAST(1000 * -best.l // best.p AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM e LEFT JOIN o USING (doc_id) LEFT JOIN l USING (doc_id)"""


@query("op13_periodic_runs", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated stretches of all documents, a tenth of them made to repeat."""
    found = periodic_runs.find_runs(periodic_runs.with_cycles(table(spark, sf_dir, "documents")))
    best = periodic_runs.longest()
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", (-F.col("best.length")).alias("length"), "best.period",
        F.floor(-1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            {crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind FROM conversations),
x AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM x),
f AS (SELECT *, bare = '' AS blank, bare <> '' AND seen AS duplicate, bare <> '' AND NOT seen AND right(bare, 1) NOT IN ('.', '!', '?') AS cut,
             left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
-- states: 0 nothing said, 1 after system, 2 after user, 3 after assistant; an insertion may come before a turn
st(q, pre, pq, pre_cost, pre_out) AS (VALUES (0, '', 0, 0, []), (1, '', 1, 0, []), (2, '', 2, 0, []), (3, '', 3, 0, []),
                                             (0, 'I', 2, 2, ['user:']), (1, 'I', 2, 2, ['user:']), (3, 'I', 2, 2, ['user:']), (2, 'I', 3, 2, ['assistant:'])),
p AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS best FROM f
      UNION ALL
      SELECT conv_id, i, q, min(best) FROM (
        SELECT f.conv_id, f.i, e.q, {{'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.audit, 'lines': list_concat(p.best.lines, e.lines)}} AS best
        FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1,
        LATERAL (SELECT p.q AS q, CAST(3 AS BIGINT) AS cost, 'D' AS audit, CAST([] AS VARCHAR[]) AS lines
                 UNION ALL SELECT CASE WHEN f.r = 's' THEN 1 WHEN f.r = 'u' THEN 2 ELSE 3 END, st.pre_cost + CASE WHEN f.cut THEN 1 ELSE 0 END, st.pre || 'K', list_append(st.pre_out, f.role || ':' || f.text)
                           FROM st WHERE st.q = p.q AND NOT f.blank AND NOT f.duplicate AND ((f.r = 's' AND st.pq = 0) OR (f.r = 'u' AND st.pq IN (0, 1, 3)) OR (f.r = 'a' AND st.pq = 2))
                 UNION ALL SELECT CASE WHEN st.pq = 2 THEN 3 ELSE 2 END, st.pre_cost + 2 + CASE WHEN f.cut THEN 1 ELSE 0 END, st.pre || 'R', list_append(st.pre_out, CASE WHEN st.pq = 2 THEN 'assistant:' ELSE 'user:' END || f.text)
                           FROM st WHERE st.q = p.q AND NOT f.blank AND NOT f.duplicate AND f.r <> CASE WHEN st.pq = 2 THEN 'a' ELSE 'u' END) e) GROUP BY 1, 2, 3),
z AS (SELECT conv_id, CASE q WHEN 1 THEN {{'cost': best.cost + 4, 'audit': best.audit || 'II', 'lines': list_concat(best.lines, ['user:', 'assistant:'])}}
                             WHEN 2 THEN {{'cost': best.cost + 2, 'audit': best.audit || 'I', 'lines': list_append(best.lines, 'assistant:')}} ELSE best END AS best,
             i, max(i) OVER (PARTITION BY conv_id) AS n FROM p),
y AS (SELECT conv_id, min(best) AS best FROM z WHERE i = n GROUP BY 1),
c AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
             count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(y.best.cost, 0) AS BIGINT) AS cost, coalesce(y.best.audit, '') AS audit, sha256(coalesce(array_to_string(y.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op12_turn_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by checksum and repaired at the least cost."""
    talk = table(spark, sf_dir, "conversations")
    return turn_repair.of_all(talk, turn_repair.summaries(turn_repair.repair(turn_repair.damaged(talk))))


@query("op11_simhash_cover")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near fingerprints among all documents."""
    return simhash_cover.link_groups(table(spark, sf_dir, "documents"))
