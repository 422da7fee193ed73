"""Document fingerprints (1): Order MinHash, with DataFrame functions only.

A text's tokens are runs without ASCII white space, cut at ``TOKEN`` characters.  Its k-mers are ``K`` tokens from
every place on (fewer at the end).  Repeated k-mers are numbered, so that each has a hash of its own.  Sketch ``j`` of
``SKETCHES`` looks at the hash circle from its own starting point, takes the first ``KEPT`` k-mers, puts them in text
order and hashes that tuple.  Shuffled parts change tuples, though not the set of k-mers: the share of equal sketches
follows edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import let
from tidemark.llm._common import pick, staged

TOKEN, K, KEPT = 16, 3, 2
#: starting points on the circle: one per value of the hash's first six bits
SKETCH_BITS = 6
SKETCHES = 1 << SKETCH_BITS
_HIGH, _LOW = -(1 << 32), (1 << 32) - 1


def _kmers(text: Column) -> Column:
    """Hashes of the k-mers by place."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^ \t\n\x0B\f\r]{{1,{TOKEN}}}"), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, K)])))


def _at(value: Column) -> Column:
    """Place of a k-mer, the lower half of its entry."""
    return value.bitwiseAND(F.lit(_LOW))


def _numbered(entries: Column) -> Column:
    """Sorted entries of hash (upper half) and place; the second and later of equal hashes get hashes by their number."""
    upper = lambda j: F.shiftright(F.get(entries, j), 32)
    first = F.filter(F.sequence(F.lit(0), F.size(entries) - 1), lambda j: (j == 0) | (upper(j) != upper(j - 1)))

    def runs(starts: Column) -> Column:
        def run(begin: Column, r: Column) -> Column:
            end = F.coalesce(F.get(starts, r + 1), F.size(entries)) - 1
            return F.transform(
                F.sequence(begin, end),
                lambda j: F.when(j == begin, F.get(entries, j)).otherwise(F.xxhash64(upper(j), j - begin).bitwiseAND(F.lit(_HIGH)).bitwiseOR(_at(F.get(entries, j)))),
            )

        return F.sort_array(F.flatten(F.transform(starts, run)))

    alike = F.size(F.array_distinct(F.transform(entries, lambda x: F.shiftright(x, 32)))) < F.size(entries)
    return F.when(alike, let(first, runs)).otherwise(entries)


def _tuples(entries: Column, kmers: Column) -> Column:
    """The sketches: per starting point the next entries on the circle, in text order, as a hash of two bytes."""
    arc = lambda x: F.shiftright(x, 64 - SKETCH_BITS)
    # the first few of each arc; those of an arc with fewer follow in the next
    near = F.filter(entries, lambda x, i: (i < KEPT) | (arc(F.get(entries, i - KEPT)) != arc(x)))

    def all_of(kept: Column) -> Column:
        return let(
            F.transform(kept, arc),
            lambda arcs: let(
                F.concat(kept, F.slice(kept, 1, KEPT)),
                lambda circle: F.transform(F.sequence(F.lit(-SKETCHES // 2).cast("long"), F.lit(SKETCHES // 2 - 1).cast("long")), lambda j: one(arcs, circle, j)),
            ),
        )

    def one(arcs: Column, circle: Column, j: Column) -> Column:
        found = F.array_position(arcs, j).cast("int")
        begin = F.when(found > 0, found).otherwise(F.size(F.filter(arcs, lambda a: a < j)) + 1)
        begin = F.when(begin > F.size(arcs), F.lit(1)).otherwise(begin)
        ordered = F.sort_array(F.transform(F.slice(circle, begin, KEPT), _at))
        return F.xxhash64(F.transform(ordered, lambda p: F.get(kmers, p.cast("int")))).bitwiseAND(F.lit(0xFFFF)).cast("int")

    return F.when(F.size(entries) == 0, F.array_repeat(F.lit(0), SKETCHES)).otherwise(let(near, all_of))


def sketch(text: Column) -> Column:
    """Sketches of a whole text as ``array<int>``; null, empty and blank texts have zeros; equal texts have equal ones."""
    entries = lambda g: F.sort_array(F.transform(g, lambda x, i: x.bitwiseAND(F.lit(_HIGH)).bitwiseOR(i.cast("long"))))
    return let(_kmers(text), lambda g: let(entries(g), lambda q: let(_numbered(q), lambda u: _tuples(u, g))))


def fingerprint(sketches: Column) -> Column:
    """Sketches as a string, four hexadecimal digits each."""
    return F.array_join(F.transform(sketches, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches, 0 to 1."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.lit(float(SKETCHES))


def next_ids(ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, next_id)``: the next smaller id of each, the largest after the smallest.

    Ids are dealt out by range and numbered within ranges; only one row per range is ordered in one place.  Null ids
    are left out and repeated ids count once.
    """
    known = pick(ids, doc_id=id_col).where("doc_id is not null").distinct()
    dealt = staged(known.repartitionByRange(F.desc("doc_id")).withColumn("part", F.spark_partition_id()))
    inner = dealt.withColumn("after", F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id"))))
    heads = dealt.groupBy("part").agg(F.max("doc_id").alias("head"))
    top = heads.agg(F.max("head").alias("top"))
    follows = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("follows"))
    return inner.join(follows, "part", "left").select("doc_id", F.coalesce("after", "follows", F.lit(None)).alias("after")).join(F.broadcast(top)).select("doc_id", F.coalesce("after", "top").alias("next_id"))


def spliced(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, next_id, text, edited)``: the last half of each text replaced by as much of the next document's beginning.

    Null texts are empty.  Rows with a null id have no next document and lose their last half.  Ids are taken to be
    unique; of rows that share one, each is spliced with each row of the next id.  The only text that moves twice is
    the beginning that the document before asks for.
    """
    # names that the table can't have: two sides of a join that only differ in a renamed column share no exchange
    rows = pick(docs, own_key=id_col, own_text=text_col).withColumn("own_text", F.coalesce("own_text", F.lit("")))
    sizes = rows.select("own_key", F.char_length("own_text").alias("n")).where("own_key is not null").groupBy("own_key").agg(F.max("n").alias("n"))
    order = next_ids(rows, "own_key").withColumnRenamed("doc_id", "asker")
    follow = order.join(sizes, order["asker"] == sizes["own_key"]).select("asker", F.col("next_id").alias("asked"), F.expr("n div 2").cast("int").alias("half"))
    known = rows.where("own_key is not null").repartition("own_key")
    begins = known.join(follow, F.col("own_key") == F.col("asked")).select("asker", F.col("asked").alias("next_id"), F.substring("own_text", F.lit(1), F.col("half")).alias("begin"))
    met = known.join(begins, F.col("own_key") == F.col("asker")).select("own_key", "own_text", "next_id", "begin")
    met = met.unionByName(rows.where("own_key is null").select("own_key", "own_text", F.col("own_key").alias("next_id"), F.lit("").alias("begin")))
    half = F.expr("char_length(own_text) div 2").cast("int")
    kept = (F.char_length("own_text") - half).cast("int")
    return met.select(F.col("own_key").alias("doc_id"), "next_id", F.col("own_text").alias("text"), F.concat(F.substring(F.col("own_text"), F.lit(1), kept), F.substring(F.col("begin"), F.lit(1), half)).alias("edited"))
