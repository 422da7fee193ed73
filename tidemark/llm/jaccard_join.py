"""N-gram Jaccard join (5): rare-first prefixes, length, positional and suffix filters, exact verification once per pair.

A document's set is its distinct word shingles as 64-bit hashes.  Documents of equal sets form one class with one
representative.  All shingles are counted into a table of fixed size, which orders them rare first (the order decides
the work, never the result).  Two sets of the wanted similarity share a shingle among the first ``n - ceil(t n) + 1``
of each, so representatives meet on those.

A class of thousands of near copies would meet in all pairs.  So the links are found in rounds: every representative
meets a few centres of each shared shingle, and takes the likeliest centre only; components of the verified links
follow, and further rounds as long as links are found.  Then only candidate pairs between different components are
left, which are verified one and all.  A pair is skipped only if its ends are known to be in one component already.

Pairs that only look alike are dropped inside the join that makes them: each set comes as 1,024 parity bits of its
elements' places, and two sets differ in as many elements as in bits, or more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import map_arrow, pick, sent, slices, staged, texts_of

#: places of the table of shingle counts: bounded, whatever the number of shingles
TABLE = 1 << 22
#: sets that are compared with one copy of a centre
CENTRE_SHARE = 500
#: parity bits of a set, as longs of 64
WORDS = 16
BITS = [f"b{k}" for k in range(WORDS)]
#: pairs whose ids are broadcast at most
BROADCAST_PAIRS = 500_000
#: rounds of centres at most before all remaining pairs between components are verified
ROUNDS = 3
#: centres go on while a round adds this part of all links
FEW = 20
#: sets of one component on an element from which they are kept from meeting each other
MAIN = 8
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, size: int, hashes: _Hashes) -> np.ndarray:
    """Distinct shingles of a text in order: words between ASCII white space, A-Z lower-cased; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    # the number of words is part of a short text's shingle
    size, out = (size, np.uint64(0)) if len(h) >= size else (len(h), np.uint64(len(h)))
    for k in range(size):
        out = (out ^ h[k : len(h) - size + 1 + k]) * M1
        out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix_length(n: np.ndarray | int, share: Fraction):
    return n - -(-n * share.numerator // share.denominator) + 1


def _count_table(rows: DataFrame, size: int) -> np.ndarray:
    """Logarithms of how many documents hold the shingles of each place of the table."""
    slots = 1024
    width = TABLE // slots

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _Hashes(), np.zeros(TABLE, np.uint32)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for text in texts_of(batch, "text"):
                np.add.at(counts, (shingles(text, size, hashes) % np.uint64(TABLE)).astype(np.int64), 1)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(slots), pa.int32()), pa.array([zlib.compress(counts[k * width : (k + 1) * width].tobytes(), 1) for k in range(slots)], pa.binary())], ["slot", "counts"])

    def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.uint64)
        for table in tables:
            for raw in table.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(raw), np.uint32)
        coded = np.minimum(np.log2(total + 1) * 4, 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([coded.tobytes()], pa.binary())], ["slot", "counts"])

    parts = sent(rows.select("text")).mapInArrow(run, "slot int, counts binary").groupBy("slot").applyInArrow(add, "slot int, counts binary")
    out = np.zeros(TABLE, np.uint8)
    for row in staged(parts).toLocalIterator():  # a row per slot
        out[row.slot * width : (row.slot + 1) * width] = np.frombuffer(row.counts, np.uint8)
    return out


def _sets(rows: DataFrame, size: int, share: Fraction, table) -> DataFrame:
    """Per document: size and digest of its set, its parity bits for the suffix filter, its prefix rare first."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        hashes, order = _Hashes(), table.value

        def one(text: str) -> tuple:
            s = shingles(text, size, hashes)
            if not len(s):
                return 0, None, np.zeros(WORDS, np.int64), []
            ranks = order[(s % np.uint64(TABLE)).astype(np.int64)]
            first = s[np.lexsort((s * M2, ranks))[: int(prefix_length(len(s), share))]]
            odd = np.bincount(((s * M3 >> np.uint64(32)) % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
            return len(s), xxhash.xxh3_128_digest(s.tobytes()), np.packbits(odd.astype(np.uint8)).view(np.int64), first.view(np.int64)

        def work(batch: pa.RecordBatch) -> dict:
            n, digest, bits, prefix = zip(*map(one, texts_of(batch, "text")))
            return {"doc_id": batch.column("doc_id"), "n": n, "digest": digest, "prefix": prefix} | dict(zip(BITS, np.array(bits).T))

        return work

    return map_arrow(rows, make, f"doc_id {kind}, n long, digest binary, prefix array<long>, " + ", ".join(f"{b} long" for b in BITS), cut_by="text")


def _meeting(reps: DataFrame, share: Fraction) -> DataFrame:
    """Prefix elements ``(token, d, n, p)`` of sets that meet another one there whose size passes the length filter.

    Ordered by size, the next smaller and the next larger set of an element tell; every element moves once.
    """
    p, q = share.numerator, share.denominator
    sizes, n = Window.partitionBy("token").orderBy("n"), F.col("n").cast("long")
    spread = reps.select(F.col("doc_id").alias("d"), F.col("n").cast("int"), F.posexplode("prefix").alias("p", "token"))
    beside = spread.withColumns({"below": F.lag(n).over(sizes), "above": F.lead(n).over(sizes)})
    return beside.where((n * p <= F.col("below") * q) | (F.col("above") * p <= n * q)).select("token", "d", "n", "p")


def _needed(share: Fraction) -> Column:
    """Elements that sets of sizes ``na`` and ``nb`` must share."""
    p, q = share.numerator, share.denominator
    return F.expr(f"({p} * (na + nb) + {p + q - 1}) div {p + q}")


def _possible(pairs: DataFrame, share: Fraction) -> DataFrame:
    """Rows of a shared prefix element that pass the length filter and the positional filter.

    Before the element at most ``least(pa, pb)`` others are shared, after it at most the shorter rest.
    """
    p, q = share.numerator, share.denominator
    bound = F.expr("least(pa, pb) + 1 + least(na - pa - 1, nb - pb - 1)")
    return pairs.where(F.expr(f"na * {p} <= nb * {q} and nb * {p} <= na * {q}") & (bound >= _needed(share)))


def _apart(a: str, b: str) -> Column:
    """Elements in which two sets differ at least: their parity bits that differ."""
    return F.expr(" + ".join(f"bit_count({a}{k} ^ {b}{k})" for k in BITS))


def _close(share: Fraction, a: str = "a_", b: str = "b_") -> Column:
    """The suffix filter: sets that share what is needed differ in no more than the rest of both."""
    return _apart(a, b) <= F.col("na") + F.col("nb") - 2 * _needed(share)


def _once(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """Each pair once, if it passes the suffix filter, with the number of prefix elements it was met on."""
    once = pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count(F.lit(1)).alias("shared"))
    for side in "ab":
        once = once.join(sets.select(F.col("doc_id").alias(side), *[F.col(k).alias(f"{side}_{k}") for k in BITS]), side)
    return once.where(_close(share)).select("a", "b", "shared")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, share: Fraction) -> DataFrame:
    """Exact check of pairs ``(a, b)``: texts of ``b`` come to copies of ``a``'s, one for ``CENTRE_SHARE`` of them.

    Texts are read again, and move as such: packed, they are smaller than the hashes of their sets. The list of the wanted ones is broadcast while it is short; beyond that it is a plain join.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    placed = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CENTRE_SHARE)).alias("copy"))
    placed = staged(placed)
    wanted = placed.select(F.col("b").alias("doc_id"), "a", "copy", F.lit(1).alias("role")).unionByName(placed.select(F.col("a").alias("doc_id"), "a", "copy", F.lit(0).alias("role")).distinct())

    if placed.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)

    def make_check():
        hashes, held = _Hashes(), [None, None, np.zeros(0, np.uint64)]

        def work(batch: pa.RecordBatch) -> dict:
            out = {"a": [], "b": []}
            for doc, a, copy, role, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "a", "copy", "role", "text"))):
                items = shingles(text, size, hashes)
                if role == 0:
                    held[:] = [a, copy, items]
                    continue
                if held[:2] != [a, copy] or not len(items) or not len(held[2]):
                    continue
                at = np.minimum(np.searchsorted(held[2], items), len(held[2]) - 1)
                both = int((held[2][at] == items).sum())
                if both * share.denominator >= share.numerator * (len(items) + len(held[2]) - both):
                    out["a"].append(a)
                    out["b"].append(doc)
            return out

        return work

    met = rows.join(wanted, "doc_id").repartition("a", "copy").sortWithinPartitions("a", "copy", "role")
    return map_arrow(met, make_check, f"a {kind}, b {kind}", cut_by="text").distinct()


def _trace(edges: DataFrame) -> tuple:
    """Count and combined hash of links: equal if nothing changed."""
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of nodes with links ``(a, b)``; the component is its smallest node.

    Large-star and small-star steps in turn, each an aggregate and a join, until no link changes; every step is written,
    and only counts reach the driver.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _trace(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = staged(small)
        now = _trace(edges)
        if now == before:
            break
        before = now
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def link_groups(docs: DataFrame, size: int = 5, threshold: str = "0.8", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with the group they reach by links of Jaccard similarity ``threshold`` or more.

    Returns ``(id, n_shingles, component_id)``, one row per input row; ``component_id`` is the smallest id that can be
    reached, the row's own included.  Null, empty and wordless texts have no shingles and stay alone; so do rows with
    a null id, whose component is null, and which link nothing.  Ids are taken to name one text: rows that share an id
    get one component, found with the smallest set digest among them.  An empty table gives an empty table.
    """
    share = Fraction(threshold)
    if not 0 < share <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    rows = pick(docs, doc_id=id_col, text=text_col)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_count_table(rows, size))
    sets = staged(_sets(rows, size, share, table))
    table.destroy()
    known = sets.where("doc_id is not null and n > 0")
    # one row per id and one representative per set
    named = known.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    classes = staged(named.groupBy("digest").agg(F.min("doc_id").alias("rep")))
    reps = known.join(classes, (known["doc_id"] == classes["rep"]) & (known["digest"] == classes["digest"]), "left_semi")
    meeting = staged(_meeting(reps, share))
    links = tried = None
    turn, total, more = 0, 0, True
    while more:
        # a round that adds few links leaves the rest to the last one
        last = turn == ROUNDS or (turn > 0 and FEW * made <= total)
        here = _labelled(meeting, links)
        if last:
            pairs = _all_pairs(here, sets, share)
        else:
            mixed = here.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
            pairs = _possible(_centre_pairs(staged(here.join(mixed, "token")), turn), share)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        if last:
            found = pairs
        else:
            found = _once(pairs, sets, share)
            # the likeliest partner of either end
            ends = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
            found = ends.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
        found = staged(found.select("a", "b"))
        checked = staged(_verified(found, rows, size, share))
        tried = found if tried is None else tried.unionByName(found)
        links = checked if links is None else links.unionByName(checked)
        made, more, turn = checked.count(), not last, turn + 1
        total += made
    # every set's component, then every row's smallest id in it
    top = F.coalesce("component", "rep")
    placed = classes.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").select("digest", top.alias("component_id"))
    by_id = named.join(placed, "digest").select("doc_id", "component_id")
    return sets.select("doc_id", F.col("n").alias("n_shingles")).join(by_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _labelled(meeting: DataFrame, links: DataFrame | None) -> DataFrame:
    """Rows with the component their document is known to be in."""
    if links is None:
        return meeting.withColumn("component", F.col("d"))
    known = components(links).withColumnRenamed("node", "d")
    return meeting.join(known, "d", "left").withColumn("component", F.coalesce("component", "d"))


def _oriented(pairs: DataFrame) -> DataFrame:
    """Pairs of a document ``d`` of size ``n`` and place ``p`` with another one, ``yd``, as ``a < b``.

    No structs are compared: over those, the method that Spark makes of join and aggregate takes the compiler of every
    executor half a gigabyte, which its process keeps.
    """
    first = F.col("d") < F.col("yd")
    ends = [F.least("d", "yd").alias("a"), F.greatest("d", "yd").alias("b")]
    rest = [column for k in "np" for column in (F.when(first, F.col(k)).otherwise(F.col(f"y{k}")).alias(f"{k}a"), F.when(first, F.col(f"y{k}")).otherwise(F.col(k)).alias(f"{k}b"))]
    return pairs.select(*ends, *rest)


def _centre_pairs(here: DataFrame, turn: int) -> DataFrame:
    """Documents with the centres of their elements: the smallest id first, then other ones in each turn."""
    own = F.struct("d", "n", "p")
    ways = [F.col("d"), F.col("n"), -F.col("n")] if turn == 0 else [F.xxhash64("d", F.lit(turn)), F.xxhash64("component", F.lit(turn))]
    centres = here.groupBy("token").agg(*[F.min(F.struct(w.alias("o"), "component", own.alias("y"))).alias(f"c{k}") for k, w in enumerate(ways)])
    listed = centres.select("token", F.explode(F.array_distinct(F.array(*[F.struct(F.col(f"c{k}.component").alias("component"), F.col(f"c{k}.y").alias("y")) for k in range(len(ways))]))).alias("c"))
    met = here.join(listed, "token").where("c.component <> component")
    return _oriented(met.select("d", "n", "p", *[F.col(f"c.y.{k}").alias(f"y{k}") for k in "dnp"])).distinct()


def _all_pairs(here: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share an element and pass all filters, each once.

    The shorter set of a pair meets the longer one, whose class of size is the same or the next.  The first element
    that a pair shares stands in the shorter set before the part that alone could hold the needed overlap, so only such
    elements of the shorter set count.  Where most sets of an element are in one component already, those don't meet
    each other: rows of that component meet the others only.  All filters are part of the join.
    """
    p, q = share.numerator, share.denominator
    # a little wider than the sizes allow: rounding of logarithms can't part a pair
    wide = F.floor(F.log(F.col("n")) / F.log(F.lit(q / p if q > p else 2.0)) * 0.999)
    early = F.expr(f"p <= n - ({2 * p} * n + {p + q - 1}) div {p + q}")
    held = here.groupBy("token", "component").agg(F.count(F.lit(1)).alias("held"), F.max(early).alias("early"))
    main = held.groupBy("token").agg(F.max_by("component", "held").alias("main"), F.max("held").alias("most"), F.count(F.lit(1)).alias("components"), F.max("early").alias("early"))
    # a small component is not worth a second copy of the others; elements that are early in no set make no pair
    main = main.where("components > 1 and early").select("token", F.when(F.col("most") >= MAIN, F.col("main")).alias("main"))
    rows = here.join(main, "token").join(sets.select(F.col("doc_id").alias("d"), *BITS), "d").withColumns({"size": wide, "in_main": F.coalesce(F.col("component") == F.col("main"), F.lit(False))})
    first = rows.where(early)
    left = first.select(
        "token", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size"), F.col("component").alias("ca"), F.col("d").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"),
        F.when(F.col("in_main") | F.col("main").isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))).alias("sides"), *[F.col(k).alias(f"a_{k}") for k in BITS],
    ).withColumn("side", F.explode("sides")).drop("sides")
    right = rows.select("token", "size", F.col("in_main").alias("side"), F.col("component").alias("cb"), F.col("d").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"), *[F.col(k).alias(f"b_{k}") for k in BITS])
    met = left.join(right, ["token", "size", "side"]).where("ca <> cb and (na < nb or na = nb and a < b)")
    return _possible(met, share).where(_close(share)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def keep_one(docs: DataFrame, size: int = 5, threshold: str = "0.8", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that stand for their group, those of its smallest id, with all columns; rows without a group stay."""
    groups = link_groups(docs, size, threshold, id_col, text_col)
    gone = staged(groups.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct())
    if gone.count() <= BROADCAST_PAIRS:
        gone = F.broadcast(gone)
    return docs.join(gone, id_col, "left_anti")
