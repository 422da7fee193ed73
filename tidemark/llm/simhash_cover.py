"""SimHash near-duplicates by covering locality-sensitive hashing (11).

A fingerprint bit is the majority of the shingles' hash bits.  The 64 places get vectors of ``r + 1`` bits in turn, none
zero.  Every nonzero vector of ``r + 1`` bits gives a mask: the places whose vector has an odd product with it.  Any
``r`` places leave a mask that holds none of them, as ``r`` linear conditions on ``r + 1`` bits have a solution that is
not zero: two fingerprints that differ in ``r`` bits at most agree on that mask, so they meet in its table, always.

Fingerprints are compared once each, however many texts have them.  A bucket of many fingerprints is dealt to smaller
buckets by the same masks over the places that its own masks left open, so nothing is lost there either; after three
such levels few places are open and a bucket is small by itself.  In a bucket the links of a spanning forest are kept,
not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm._common import map_arrow, pick, sent, staged, texts_of
from tidemark.llm.jaccard_join import components

BITS = 64
#: fingerprints of a bucket that one task compares, and words hashed at a time
MOST, BLOCK = 1024, 50_000
#: open places with which a bucket holds ``2 ** OPEN`` fingerprints at most; with more, every mask closes some
OPEN = 10
#: hot buckets whose list is broadcast at most
BROADCAST_BUCKETS = 100_000


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of all shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    begins, ends = begins[: len(words) - size + 1], ends[size - 1 :]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(begins), BLOCK):
        h = [xxhash.xxh64_intdigest(line[a:b], seed) for a, b in zip(begins[k : k + BLOCK].tolist(), ends[k : k + BLOCK].tolist())]
        counts += np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` with the 64 bits as a signed long, one row per input row; null and wordless texts have 0."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        return lambda batch: {"doc_id": batch.column("doc_id"), "fingerprint": np.array([fingerprint(t, size, seed) for t in texts_of(batch, "text")], np.uint64).view(np.int64)}

    return map_arrow(rows, make, f"doc_id {kind}, fingerprint long", cut_by="text").withColumnRenamed("doc_id", id_col)


def masks(places: list[int], radius: int) -> list[int]:
    """Masks over ``places``: whatever ``radius`` of them differ, one mask holds none of those."""
    full = (1 << radius + 1) - 1
    given = {p: 1 + k % full for k, p in enumerate(places)}
    return [sum(1 << p for p, v in given.items() if (v & m).bit_count() % 2) for m in range(1, full + 1)]


def _deal(rows: DataFrame, radius: int, kind: str) -> DataFrame:
    """Rows ``(mask, node, fp)`` under every mask over the places that their own mask leaves open."""

    def make():
        further: dict[int, list[int]] = {}

        def work(batch: pa.RecordBatch) -> dict:
            own, fp = (batch.column(c).to_numpy().view(np.uint64) for c in ("mask", "fp"))
            which, wide = [], []
            for m in np.unique(own).tolist():
                if m not in further:
                    further[m] = sorted({m | x for x in masks([p for p in range(BITS) if not m >> p & 1], radius)})
                at = np.flatnonzero(own == m)
                which.append(np.tile(at, len(further[m])))
                wide.append(np.repeat(np.array(further[m], np.uint64), len(at)))
            which, wide = np.concatenate(which), np.concatenate(wide)
            return {"mask": wide.view(np.int64), "key": (fp[which] & wide).view(np.int64), "node": batch.column("node").take(pa.array(which)), "fp": fp[which].view(np.int64)}

        return work

    return map_arrow(rows, make, f"mask long, key long, node {kind}, fp long")


def forest(fp: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links of a spanning forest: each fingerprint that is reached is compared with those not reached yet."""
    rest, reached, parents, children = np.arange(1, len(fp)), [0], [], []
    while len(rest):
        if not reached:
            reached, rest = [int(rest[0])], rest[1:]
            continue
        x = reached.pop()
        near = np.bitwise_count(fp[rest] ^ fp[x]) <= radius
        if near.any():
            found = rest[near].tolist()
            parents += [x] * len(found)
            children += found
            reached += found
            rest = rest[~near]
    return parents, children


def _linked(rows: DataFrame, radius: int, kind: str) -> DataFrame:
    """Links ``(a, b)`` of a forest of every bucket; a bucket has ``MOST`` rows at most."""
    schema = StructType.fromDDL(f"a {kind}, b {kind}")
    arrow = to_arrow_schema(schema)

    def links(held: pa.Table) -> pa.RecordBatch:
        mask, key, fp = (held.column(c).to_numpy() for c in ("mask", "key", "fp"))
        fp = fp.view(np.uint64)
        begins = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]))
        sizes = np.diff(np.append(begins, len(fp)))
        two = begins[sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = [two], [two + 1]
        for begin, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            parents, children = forest(fp[begin : begin + size], radius)
            a.append(np.array(parents, np.int64) + begin)
            b.append(np.array(children, np.int64) + begin)
        node = held.column("node").combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(x))).cast(f.type) for x, f in zip((a, b), arrow)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            mask, key = held.column("mask").to_numpy(), held.column("key").to_numpy()
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))
            if len(new):  # the last bucket may go on
                yield links(held.slice(0, int(new[-1]) + 1))
                held = held.slice(int(new[-1]) + 1)
        if held is not None and held.num_rows:
            yield links(held)

    return sent(rows.repartition("mask", "key").sortWithinPartitions("mask", "key")).mapInArrow(run, schema)


def _in(rows: DataFrame, hot: DataFrame, few: bool, how: str) -> DataFrame:
    """Rows of the listed buckets (or of all others); a long list is joined by salted keys, as a bucket may be large."""
    if few:
        return rows.join(F.broadcast(hot), ["mask", "key"], how)
    salt = 32
    spread = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("fp"), F.lit(salt))).join(spread, ["mask", "key", "salt"], how).drop("salt")


def links(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``(a, b)`` that join all ``(node, fp)`` of unlike fingerprints within ``radius`` bits, through others at least."""
    kind = classes.schema["node"].dataType.simpleString()
    rows, found = classes.select(F.lit(0).cast("long").alias("mask"), "node", "fp"), None
    while True:
        dealt = _deal(rows, radius, kind)
        hot = staged(dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > MOST) & (F.bit_count("mask") < BITS - OPEN)).select("mask", "key"))
        count = hot.count()
        few = count <= BROADCAST_BUCKETS
        made = staged(_linked(dealt if count == 0 else _in(dealt, hot, few, "left_anti"), radius, kind).distinct())
        found = made if found is None else found.unionByName(made)
        if count == 0:
            return found
        rows = staged(_in(dealt, hot, few, "left_semi").select("mask", "node", "fp"))


def link_groups(docs: DataFrame, size: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with their fingerprint and the group they reach by fingerprints that differ in ``radius`` bits at most.

    Returns ``(id, fingerprint, component_id)``, one row per input row, the fingerprint as 16 hexadecimal digits and the
    smallest id that can be reached, the row's own included.  Words lie between ASCII white space, A-Z lower-cased;
    texts of fewer than ``size`` words are one shingle; null, empty and wordless texts have fingerprint zero and link
    like any other.  Ids are taken to name one text: rows that share an id get one component, found with the smallest
    signed fingerprint among them.  Rows with a null id link nothing, their component is null.  An empty table gives an
    empty table.
    """
    if not 0 < radius < 8:
        raise ValueError("radius must be from 1 to 7")
    rows = staged(fingerprints(docs, size, seed, id_col, text_col).select(F.col(id_col).alias("id"), F.col("fingerprint").alias("fp")))
    named = rows.where("id is not null").groupBy("id").agg(F.min("fp").alias("fp"))
    classes = staged(named.groupBy("fp").agg(F.min("id").alias("node")))
    top = components(links(classes, radius))
    placed = classes.join(top, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    by_id = named.join(placed, "fp").select("id", "component_id")
    return rows.join(by_id, "id", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
