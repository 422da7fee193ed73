"""Toxicity (8): hashed word embeddings, filters of several widths, max pooling; thresholds by language.

Training reads every usable label.  Rows are dealt into shards of a bounded size; in each round every shard takes the
common weights some steps further in its own task, and their mean is where the next round begins.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import map_arrow, pick, sent, settle, staged, texts_of

WIDTHS = (1, 2, 3)
EMBEDDING = 16
FILTERS = 12
#: rows of a class and words that a shard holds, about, and the least rows of the rarer class, which is dealt into fewer parts
SHARD_ROWS, SHARD_WORDS, SHARD_LEAST = 6_000, 4_000_000, 500
#: labelled ids go into a bitmap of this many places, so that other documents are not moved
PLACES = 1 << 25
#: words that are scored at one time; longer texts are cut into overlapping pieces whose maxima are joined
PIECE_WORDS = 50_000
STEPS, BATCH, RATE = 1000, 64, 0.005
#: times that the shards' weights are joined, numbers of the weights that one row holds on the way
ROUNDS, CHUNK = 8, 4_096
#: scores are counted in cells of this share of a unit of their logit
CELLS = 1_024
EMBEDDING_RATE, DECAY = 1.0, 0.001
#: a word gets an embedding from so many texts on, as a share of the smaller class
LEAST_SHARE = 0.01
GAP = max(WIDTHS) - 1

#: white space for every ASCII character that is no letter, digit or apostrophe
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() or c == 0x27 else 0x20 for c in range(256))


class _Hashes(dict):
    """Hash of each word; with rows given, the row of its embedding and the last row for words without one."""

    def __init__(self, rows: dict[int, int] | None = None):
        self.rows = rows

    def __missing__(self, word: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        found = zlib.crc32(word)
        self[word] = found = found if self.rows is None else self.rows.get(found, len(self.rows))
        return found


def hashed(text: str, hashes: _Hashes) -> np.ndarray:
    """Hashes (or rows) of a text's words, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().translate(_PLAIN).split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint32, len(words))


@dataclass
class Model:
    """Weights; the last embedding stands for unknown words and the space between texts and stays zero."""

    #: row of the embedding by the word's hash
    rows: dict[int, int]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    #: score from which a text of a language is rejected
    thresholds: dict[str | None, float] = field(default_factory=dict)
    default_threshold: float = 0.5

    @classmethod
    def new(cls, known: np.ndarray, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.02, (len(known) + 1, EMBEDDING)).astype(np.float32)
        embedding[-1] = 0
        filters = {w: rng.normal(0, 0.5 / np.sqrt(w), (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS}
        return cls({int(h): k for k, h in enumerate(known)}, embedding, filters, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def pooled(self, texts: list[np.ndarray], want_places: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Largest response of every filter in every text (zero for an empty one), where it was, and the words laid end to end."""
        sizes = np.array([len(t) for t in texts])
        gap = np.full(GAP, len(self.rows), np.uint32)
        flat = np.concatenate([x for t in texts for x in (t, gap)])
        begins = np.cumsum(np.r_[0, sizes + GAP])[:-1]
        filled = np.flatnonzero(sizes)
        out = np.zeros((len(texts), len(self.out)), np.float32)
        places = np.zeros(out.shape, np.int64) if want_places else None
        if len(filled):
            # words that occur often are multiplied once
            known, code = np.unique(flat, return_inverse=True)
            vectors = self.embedding[known]
            edges = np.stack([begins[filled], begins[filled] + sizes[filled]], axis=1).ravel()
            for n, w in enumerate(WIDTHS):
                rows = len(flat) - w + 1
                response = np.zeros((rows, FILTERS), np.float32)
                for k in range(w):
                    response += (vectors @ self.filters[w][k * EMBEDDING : (k + 1) * EMBEDDING])[code[k : k + rows]]
                response = np.concatenate([response, np.full((w, FILTERS), -np.inf, np.float32)])
                part = slice(n * FILTERS, (n + 1) * FILTERS)
                out[filled, part] = np.maximum.reduceat(response, edges, axis=0)[::2] + self.bias[w]
                if want_places:
                    for row in filled:
                        places[row, part] = begins[row] + response[begins[row] : begins[row] + sizes[row]].argmax(axis=0)
        return out, places, flat

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of hashed words."""
        return np.fromiter((self.rows.get(h, len(self.rows)) for h in hashes.tolist()), np.uint32, len(hashes))

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.out + self.out_bias

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of whole texts from 0 to 1; pieces of long texts overlap by the widest filter."""
        owner, pieces = _pieces(texts)
        best = np.full((len(texts), len(self.out)), -np.inf, np.float32)
        for group in _groups(pieces):
            np.maximum.at(best, owner[group], self.pooled([pieces[k] for k in group])[0])
        return 1 / (1 + np.exp(-np.clip(self.logits(best), -30, 30)))


def _groups(pieces: list[np.ndarray]) -> Iterator[list[int]]:
    held, words = [], 0
    for k, p in enumerate(pieces):
        if held and words + len(p) > PIECE_WORDS:
            yield held
            held, words = [], 0
        held.append(k)
        words += len(p)
    if held:
        yield held


def _weights(model: Model) -> dict[str, np.ndarray]:
    """The dense weights by name."""
    return {f"filter{w}": model.filters[w] for w in WIDTHS} | {f"bias{w}": model.bias[w] for w in WIDTHS} | {"out": model.out}


@dataclass
class _Fit:
    """A model on the way: its weights and what Adam keeps of their slopes (``out_bias`` is held beside the model)."""

    model: Model
    out_bias: np.ndarray
    m: dict[str, np.ndarray]
    v: dict[str, np.ndarray]
    t: int = 0

    @classmethod
    def new(cls, known: np.ndarray, seed: int) -> _Fit:
        model = Model.new(known, seed)
        bias = np.zeros(1, np.float32)
        zeros = lambda: {k: np.zeros_like(w) for k, w in (_weights(model) | {"out_bias": bias}).items()}
        return cls(model, bias, zeros(), zeros())

    def arrays(self) -> list[np.ndarray]:
        dense = _weights(self.model) | {"out_bias": self.out_bias}
        return [self.model.embedding, *dense.values(), *(self.m[k] for k in dense), *(self.v[k] for k in dense)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for a in self.arrays():
            a[...] = flat[at : at + a.size].reshape(a.shape)
            at += a.size

    def step(self, grads: dict[str, np.ndarray]) -> None:
        """A step of Adam on the dense weights."""
        self.t += 1
        for name, w in (_weights(self.model) | {"out_bias": self.out_bias}).items():
            m, v, g = self.m[name], self.v[name], grads[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= RATE * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
        self.model.out_bias = float(self.out_bias[0])


def _pieces(texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pieces of whole texts that overlap by the widest filter, and the text of each."""
    found = [(k, t[at : at + PIECE_WORDS + GAP]) for k, t in enumerate(texts) for at in range(0, max(len(t) - GAP, 1), PIECE_WORDS)]
    return np.array([k for k, _ in found], np.int64), [p for _, p in found]


def _responses(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Largest response of every filter in every whole text, and the words (rows of the embedding) under it by width."""
    best = np.full((len(texts), len(model.out)), -np.inf, np.float32)
    under = {w: np.full((len(texts), FILTERS, w), len(model.rows), np.int64) for w in WIDTHS}
    owner, pieces = _pieces(texts)
    for group in _groups(pieces):
        pooled, places, flat = model.pooled([pieces[k] for k in group], True)
        for row, text in enumerate(owner[group]):
            more = pooled[row] > best[text]
            best[text, more] = pooled[row, more]
            for n, w in enumerate(WIDTHS):
                part = slice(n * FILTERS, (n + 1) * FILTERS)
                at = np.minimum(places[row, part][more[part], None] + np.arange(w), len(flat) - 1)
                under[w][text, more[part]] = flat[at]
    return best, under


def advance(state: _Fit, texts: list[np.ndarray], labels: np.ndarray, begin: int, steps: int, seed: list[int]) -> None:
    """Train on texts of known words: as many of either class in a batch, logistic loss, gradients at the pooled places only.

    Each class is gone through in one random order after another, so that all of its rows come up; ``begin`` is the
    number of steps taken in earlier rounds.
    """
    model, half = state.model, BATCH // 2
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    orders: dict[tuple[int, int], np.ndarray] = {}

    def turn(c: int, k: int) -> int:
        pass_no, at = divmod(k, len(classes[c]))
        if (c, pass_no) not in orders:
            orders[c, pass_no] = np.random.default_rng([*seed, c, pass_no]).permutation(classes[c])
        return orders[c, pass_no][at]

    for step in range(begin, begin + steps):
        rows = np.array([turn(c, step * half + k) for c in (0, 1) for k in range(half)])
        want = labels[rows].astype(np.float32)
        pooled, under = _responses(model, [texts[k] for k in rows])
        off = (1 / (1 + np.exp(-np.clip(model.logits(pooled), -30, 30))) - want) / len(rows)
        kept = np.maximum(pooled, 0)
        grads = {"out": kept.T @ off + 1e-4 * model.out, "out_bias": np.array([off.sum()], np.float32)}
        to_pooled = off[:, None] * model.out * (pooled > 0)
        touched, slopes = [], []
        for n, w in enumerate(WIDTHS):
            g = to_pooled[:, n * FILTERS : (n + 1) * FILTERS]
            grads[f"bias{w}"] = g.sum(axis=0)
            grad = 1e-4 * model.filters[w]
            for k in range(w):
                words = under[w][:, :, k]
                block = slice(k * EMBEDDING, (k + 1) * EMBEDDING)
                grad[block] += np.einsum("bf,bfe->ef", g, model.embedding[words])
                touched.append(words.ravel())
                slopes.append((g[:, :, None] * model.filters[w][block].T[None]).reshape(-1, EMBEDDING))
            grads[f"filter{w}"] = grad
        state.step(grads)
        words, back = np.unique(np.concatenate(touched), return_inverse=True)
        slope = np.zeros((len(words), EMBEDDING), np.float32)
        np.add.at(slope, back, np.concatenate(slopes))
        # plain steps: what one text alone says moves a word little, what many say adds up
        model.embedding[words] = (1 - DECAY) * model.embedding[words] - EMBEDDING_RATE * slope
        model.embedding[-1] = 0


def labelled_words(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(lang, label, held, key, words)`` of every labelled document: the hashes of all words of its whole text.

    A bitmap of fixed size tells most documents without a label before they are moved; the join decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    slots = ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toArrow()
    bitmap = np.zeros(PLACES >> 6, np.int64)
    bitmap[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bitmap)  # of a fixed size

    def make():
        bits, hashes = held.value, _Hashes()

        def work(batch: pa.RecordBatch) -> dict | None:
            at = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1))
            if not batch.num_rows:
                return None
            return {"words": [hashed(t, hashes).tobytes() for t in texts_of(batch, "text")]} | {c: batch.column(c) for c in ("doc_id", "lang", "key")}

        return work

    rows = docs.where("doc_id is not null").withColumns({"place": place, "key": F.xxhash64("doc_id", "text")})
    found = map_arrow(rows, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, key long, words binary", cut_by="text")
    apart = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) == 0
    return found.join(ids, "doc_id").select("lang", "label", apart.alias("held"), "key", "words")


def vocabulary(rows: DataFrame, least: float) -> np.ndarray:
    """Hashes of the words that ``least`` texts have, counted over all rows; few, as each stands for many texts."""

    def make():
        def work(batch: pa.RecordBatch) -> dict | None:
            words, seen = np.unique(np.concatenate([np.unique(np.frombuffer(t, np.uint32)) for t in batch.column("words").to_pylist()]), return_counts=True)
            return {"word": words.astype(np.int64), "seen": seen} if len(words) else None

        return work

    counts = map_arrow(rows.select("words"), make, "word long, seen long", cut_by="words").groupBy("word").agg(F.sum("seen").alias("seen"))
    return np.sort(staged(counts.where(F.col("seen") >= least).select("word")).toArrow()["word"].to_numpy()).astype(np.uint32)


def shards(rows: DataFrame, known: np.ndarray, sizes: list[int], words: int) -> DataFrame:
    """``(shard, most, labels, sizes, words)``: every row in one shard, those of the rarer class in as many as need them.

    A shard is one row with the known words of its texts end to end, so that rounds read it without a shuffle.
    """
    count = max(1, -(-max(sizes) // SHARD_ROWS), -(-words // SHARD_WORDS))
    parts = F.lit(max(1, min(count, sizes[0] // SHARD_LEAST)))
    parts = F.when(F.col("label") == 1, F.lit(max(1, min(count, sizes[1] // SHARD_LEAST)))).otherwise(parts)
    held = rows.sparkSession.sparkContext.broadcast({int(h): k for k, h in enumerate(known)})

    def make():
        own = held.value

        def work(batch: pa.RecordBatch) -> dict:
            ids = [np.fromiter((own.get(h, len(own)) for h in np.frombuffer(t, np.uint32).tolist()), np.uint32).tobytes() for t in batch.column("words").to_pylist()]
            return {"words": ids} | {c: batch.column(c) for c in ("shard", "label", "key")}

        return work

    def pack(key: tuple, part: pa.Table) -> pa.Table:
        found = sorted(zip(part["key"].to_pylist(), part["label"].to_pylist(), part["words"].to_pylist()))
        sizes = np.array([len(w) // 4 for *_, w in found], np.int64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "most": pa.array([max(sum(y == c for _, y, _ in found) for c in (0, 1))], pa.int64()), "labels": pa.array([bytes(y for _, y, _ in found)], pa.binary()), "sizes": pa.array([sizes.tobytes()], pa.binary()), "words": pa.array([b"".join(w for *_, w in found)], pa.binary())})

    dealt = rows.withColumn("part", F.pmod("key", parts)).withColumn("shard", F.explode(F.sequence(F.col("part"), F.lit(count - 1).cast("long"), parts.cast("long"))))
    return map_arrow(dealt.select("shard", "label", "key", "words"), make, "shard long, label int, key long, words binary", cut_by="words").groupBy("shard").applyInArrow(pack, "shard long, most long, labels binary, sizes binary, words binary")


def changes(packed: DataFrame, state: Broadcast, steps: int, begin: int, seed: int) -> DataFrame:
    """``(chunk, shards, change)``: by how much a round moves the weights, summed over the ``shards`` that a task trains.

    A task trains its shards one after another, each from the common weights, and sends their sum once, so that what a
    round moves grows with the cores and not with the rows; words that no shard of a task touched are runs of zeros.
    Sums are of double width, so that the weights don't hang on which shards meet in a task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(__name__)
        start, change, count = state.value.flat(), 0.0, 0
        for batch in batches:
            for shard, labels, sizes, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "labels", "sizes", "words"))):
                own = copy.deepcopy(state.value)
                texts = np.split(np.frombuffer(words, np.uint32), np.cumsum(np.frombuffer(sizes, np.int64))[:-1])
                advance(own, texts, np.frombuffer(labels, np.uint8), begin, steps, [seed, shard])
                change, count = change + (own.flat().astype(np.float64) - start), count + 1
        if count:
            parts = [change[k : k + CHUNK].tobytes() for k in range(0, len(start), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array([count] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "shards", "change"])

    return sent(packed.coalesce(packed.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, "chunk long, shards long, change binary")


def fit(packed: DataFrame, known: np.ndarray, seed: int = 7) -> Model:
    """The model after all rounds over all shards; within a round the shards' weights are their own, then their mean."""
    spark, state = packed.sparkSession, _Fit.new(known, seed)
    most = packed.agg(F.max("most")).first()[0]
    # all rows of the largest shard come up
    steps = -(-max(STEPS, -(-int(most) // (BATCH // 2))) // ROUNDS)

    def mean(key: tuple, part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.float64) for v in sorted(part["change"].to_pylist()))
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "change": pa.array([(total / pc.sum(part["shards"]).as_py()).tobytes()], pa.binary())})

    for turn in range(ROUNDS):
        held = spark.sparkContext.broadcast(state)
        # stored, so that the round's shuffle files go with it
        found = staged(changes(packed, held, steps, turn * steps, seed).groupBy("chunk").applyInArrow(mean, "chunk long, change binary")).toArrow().sort_by("chunk")
        state.put(state.flat() + np.frombuffer(b"".join(found["change"].to_pylist()), np.float64))
        state.t += steps
        held.destroy()
    state.model.out_bias = float(state.out_bias[0])
    return state.model


def best_cut(cells: pa.Table) -> float | None:
    """The threshold that makes the fewest errors, middle of the best range; without both classes there is none."""
    cells = cells.sort_by("cell")
    ones, n, low, high = (cells[c].to_numpy() for c in ("ones", "n", "low", "high"))
    if not ones.sum() or ones.sum() == n.sum():
        return None
    # errors if the first k cells are kept
    errors = np.r_[0, np.cumsum(ones)] + np.r_[np.cumsum((n - ones)[::-1])[::-1], 0]
    ks = np.flatnonzero(errors == errors.min())
    return float(((high[ks[0] - 1] if ks[0] else 0.0) + (low[ks[-1]] if ks[-1] < len(n) else 1.0)) / 2)


def calibrate(model: Model, rows: DataFrame, least: int = 40) -> Model:
    """Thresholds that make the fewest errors on all rows training didn't use, by language; middle of the best range.

    A language with fewer than ``least`` such rows, or without both classes, takes the threshold of all rows together;
    without both classes there it is 0.5.  Scores are counted in narrow cells, and a threshold lies between two of them.
    """
    held = rows.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def make():
        own = held.value

        def work(batch: pa.RecordBatch) -> dict:
            scores = own.scores([own.known(np.frombuffer(t, np.uint32)) for t in batch.column("words").to_pylist()]).astype(np.float64)
            return {"score": scores} | {c: batch.column(c) for c in ("lang", "label")}

        return work

    scored = map_arrow(rows.select("lang", "label", "words"), make, "lang string, label int, score double", cut_by="words")
    s = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-13)), F.lit(1e-13))
    cell = F.floor(F.log(s / (1 - s)) * CELLS)
    counted = [F.sum("ones").alias("ones"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")]
    cells = staged(scored.groupBy("lang", cell.alias("cell")).agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high")))
    every = cells.groupBy("cell").agg(*counted).select(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("lang"), "cell", "ones", "n", "low", "high")

    def cut(key: tuple, part: pa.Table) -> pa.Table:
        enough = key[0].as_py() or pc.sum(part["n"]).as_py() >= least
        return pa.table({"whole": pa.array([key[0].as_py()], pa.bool_()), "lang": pa.array([key[1].as_py()], pa.string()), "cut": pa.array([best_cut(part) if enough else None], pa.float64())})

    # a group holds a row for each cell, a few ten thousand at most
    found = cells.select(F.lit(False).alias("whole"), "*").unionByName(every).groupBy("whole", "lang").applyInArrow(cut, "whole boolean, lang string, cut double").where("cut is not null")
    for r in found.collect():
        if r.whole:
            model.default_threshold = r.cut or 0.5
        else:
            model.thresholds[r.lang] = r.cut
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", seed: int = 7) -> Model:
    """Fit on the whole texts of all labelled rows for which ``usable`` holds.

    By a hash of the id, three quarters of them serve the vocabulary and the weights, the last quarter the thresholds.
    Words of fewer texts than ``LEAST_SHARE`` of the smaller class teach chance only and get no embedding.  With one class
    only, every text gets the same score: that class's.  Null labels, null ids and labels of unknown documents are not
    used; an id labelled twice counts twice; without any labelled row all texts score alike.
    """
    ids = pick(labels, doc_id=id_col, label=label_col).where(usable & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("int"))
    rows = staged(labelled_words(pick(docs, doc_id=id_col, text=text_col, lang=lang_col), ids))
    learn = rows.where("not held")
    found = {r.label: r for r in learn.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("words") / 4).alias("words")).collect()}
    if len(found) < 2:
        model = Model.new(np.zeros(0, np.uint32), seed)
        model.out[:] = 0
        model.out_bias = 5.0 if 1 in found else -5.0
    else:
        sizes = [found[c].n for c in (0, 1)]
        known = vocabulary(learn, max(4, LEAST_SHARE * min(sizes)))
        model = fit(staged(shards(learn, known, sizes, int(sum(r.words for r in found.values())))), known, seed)
    return calibrate(model, rows.where("held"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every whole text; null and empty texts get the score of no response; repeated rows are kept."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def make():
        own = held.value
        hashes = _Hashes(own.rows)
        return lambda batch: {"doc_id": batch.column("doc_id"), "score": own.scores([hashed(t, hashes) for t in texts_of(batch, "text")]).astype(np.float64)}

    return map_arrow(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double", cut_by="text")


def threshold(model: Model, lang: Column) -> Column:
    """The calibrated threshold of a row's language."""
    out = F.lit(model.default_threshold)
    for name, value in model.thresholds.items():
        out = F.when(lang.eqNullSafe(F.lit(name)), F.lit(value)).otherwise(out)
    return out


def keep_clean(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows below their language's threshold, with all columns, scored in one pass without a join.

    A null or empty text is scored like any text without words, a null or unknown language has the default threshold;
    repeated rows are judged alike, columns of any name stay, an empty table gives an empty table.
    """
    fields = docs.schema
    cut = "__cut"
    while cut in docs.columns:
        cut += "_"
    held = docs.sparkSession.sparkContext.broadcast(model)
    cuts = docs.withColumn(cut, threshold(model, F.col(lang_col)))

    def make():
        own = held.value
        hashes = _Hashes(own.rows)

        def work(batch: pa.RecordBatch) -> dict | None:
            scores = own.scores([hashed(t, hashes) for t in texts_of(batch, text_col)])
            kept = batch.filter(pa.array(scores < batch.column(cut).to_numpy()))
            return {f.name: kept.column(f.name) for f in fields} if kept.num_rows else None

        return work

    return map_arrow(cuts, make, fields, cut_by=text_col)
