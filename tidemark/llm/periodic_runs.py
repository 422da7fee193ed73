"""Periodic run detection (13): string synchronising sets at dyadic scales.

At scale ``t`` (a power of two) every stretch of ``t`` words has a hash; a position is selected if, among the ``t + 1``
stretches that begin in its window, a smallest hash stands at the first or the last place.  The choice depends on
``2 t`` words only, so equal contexts are selected alike, and a run of period ``p`` with ``t <= p < 2 t`` and four
periods holds two selected positions one period apart.  Stretches of period ``t / 3`` at most would be selected too
often: they are left out at that scale, and the periods of those regions are supplied from the repeats of shorter
stretches that show them.

Hashes propose periods only.  Words decide: a proposal is extended to both sides by comparing words.  Texts of one
batch are searched together, so that short ones cost no call of their own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import map_arrow, pick, texts_of

#: words of a run at least, and its periods at least
LEAST_WORDS, LEAST_PERIODS = 6, 4
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M1
    return x ^ (x >> np.uint64(29))


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, and where each text begins (one place more at the end)."""
    known: dict[bytes, int] = {}
    words = [known.setdefault(w, len(known)) for text in texts for w in text]
    return np.array(words, np.int64), np.cumsum([0, *map(len, texts)])


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from every place on; places near the end see fewer."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _extended(words: np.ndarray, i: int, d: int, begin: int, end: int) -> tuple[int, int]:
    """The longest stretch around ``i`` within ``begin..end`` whose words ``d`` apart are equal."""
    right, step = i, 64
    while right + d < end:
        stop = min(right + step, end - d)
        differs = np.flatnonzero(words[right:stop] != words[right + d : stop + d])
        if len(differs):
            right += int(differs[0])
            break
        right, step = stop, step * 2
    left, step = i, 64
    while left > begin:
        stop = max(left - step, begin)
        differs = np.flatnonzero(words[stop:left] != words[stop + d : left + d])
        if len(differs):
            left = stop + int(differs[-1]) + 1
            break
        left, step = stop, step * 2
    return left, right + d


def _proposals(words: np.ndarray, bounds: np.ndarray):
    """Places and distances at which a period may hold, a pair of arrays for a scale."""
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    ends = bounds[1:][text]
    place = np.arange(len(words), dtype=np.int64)
    longest = int(np.diff(bounds).max(initial=0))
    # words of unlike texts never meet
    own = _mixed(words.astype(np.uint64) * M2 + _mixed(text.astype(np.uint64) + np.uint64(1)))
    again = place  # places whose stretch occurs once more in their text
    steps: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: places and the way to the next equal stretch
    t = 1
    while t * LEAST_PERIODS <= longest or t == 1:
        pair = np.zeros_like(own)
        if len(own) > t:
            pair[:-t] = _mixed(own[:-t] * M1 + own[t:])
        fits = again[again + 2 * t <= ends[again]]
        order = fits[np.argsort(pair[fits], kind="stable")]
        same = pair[order[:-1]] == pair[order[1:]]
        first, way = order[:-1][same], order[1:][same] - order[:-1][same]
        steps[2 * t] = (first, way)
        # regions of a period of a third of the scale at most, from repeats of half the scale
        ids = np.where(place + t <= ends, own, LAST)
        if t >= 4 and t // 2 in steps:
            at, d = steps[t // 2]
            low = (3 * d <= t) & (at + t <= ends[at])
            at, d = at[low], d[low]
            half = halves[t // 2]
            whole = half[at + t // 2 - d] == half[at + t // 2]
            at, d = at[whole], d[whole]
            ids[at] = LAST
            heads = np.ones(len(at), bool)
            by_place = np.argsort(at, kind="stable")
            at, d = at[by_place], d[by_place]
            heads[1:] = (np.diff(at) != 1) | (np.diff(d) != 0)
            yield at[heads], d[heads]
        least = _window_least(ids, t + 1)
        late = np.full_like(ids, LAST)
        late[: max(len(ids) - t, 0)] = ids[t:]
        chosen = (least != LAST) & ((least == ids) | (least == late))
        pick_ = chosen[first] & (way >= t) & (way < 2 * t)
        yield first[pick_], way[pick_]
        marked = np.zeros(len(words), bool)
        marked[first] = marked[first + way] = True
        again = np.flatnonzero(marked)
        if not len(again):
            break
        halves = {t: own, 2 * t: pair} if t > 1 else {1: own, 2: pair}
        steps = {k: v for k, v in steps.items() if k >= t}
        own, t = pair, 2 * t


def runs_of(words: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of every text, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    reached: dict[int, list[tuple[int, int]]] = {}  # by period: stretches already compared, in no order
    for at, way in _proposals(words, bounds):
        if not len(at):
            continue
        order = np.lexsort((at, way))
        last_d, done = -1, -1
        for i, d in zip(at[order].tolist(), way[order].tolist()):
            if d == last_d and i < done:
                continue
            k = int(np.searchsorted(bounds, i, "right")) - 1
            if any(a <= i < b for a, b in reached.get(d, ())):
                continue
            start, end = _extended(words, i, d, int(bounds[k]), int(bounds[k + 1]))
            last_d, done = d, end - d
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * d):
                reached.setdefault(d, []).append((start, end - d))
                found[k].append((start - int(bounds[k]), end - start, d))
    for k, runs in enumerate(found):
        # a stretch whose words repeat at a shorter distance has that as its smallest period
        found[k] = sorted(r for r in set(runs) if not any(p < r[2] and s <= r[0] and r[0] + r[1] <= s + n for s, n, p in runs))
        found[k].sort(key=lambda r: (r[0], r[2]))
    return found


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of repeated words: ``(id, n_words, runs, collapsed)``, one row per input row.

    Words lie between ASCII white space.  A run is a stretch of consecutive words with smallest period ``q`` (words
    ``q`` apart are equal), six words and four periods long at least, which no neighbouring word extends.  ``runs`` are
    structs of ``start`` (word number from 0), ``length`` and ``period`` by start, then period; ``collapsed`` has the
    words, joined by one space, that no run holds after its first ``q`` words.

    Null, empty and wordless texts have no words, no runs and an empty collapsed text.  Equal rows give equal rows; a
    null id stays; other columns are left out; an empty table gives an empty table.  Memory is bounded by a slice of
    the batch or one text.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        def work(batch) -> dict:
            texts = [t.encode("utf-8", "surrogatepass").split() for t in texts_of(batch, "text")]
            words, bounds = _numbered(texts)
            every, collapsed = runs_of(words, bounds), []
            for text, runs in zip(texts, every):
                if runs:
                    keep = np.ones(len(text), bool)
                    for start, length, period in runs:
                        keep[start + period : start + length] = False
                    text = [text[k] for k in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(text).decode("utf-8", "surrogatepass"))
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": np.diff(bounds),
                "runs": [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in every],
                "collapsed": collapsed,
            }

        return work

    return map_arrow(rows, make, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string", cut_by="text").withColumnRenamed("doc_id", id_col)


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of which a tenth, chosen by the id's checksum, repeat a few of their words from some word on.

    With ``h`` the checksum of the decimal id and ``g`` its tenth, ``h`` divisible by ten: from word ``a = g % n`` on,
    word ``i`` becomes word ``a + (i - a) % p`` with ``p = 1 + (n - a) div (3 + g % 8)``.  Other texts, texts without
    words and rows with a null id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), r"[ \t-\r]+"), lambda w: w != "")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("words", F.when(h % 10 == 0, words))
    g, n = F.floor(h / 10), F.size("words")
    a = g % n
    rows = rows.withColumn("cut", F.when(n > 0, F.struct(a.cast("int").alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))))
    cycle = F.expr("array_join(transform(words, (w, i) -> if(i < cut.a, w, words[cut.a + (i - cut.a) % cut.p])), ' ')")
    return rows.select(F.col("doc_id").alias(id_col), F.when(F.col("cut").isNotNull(), cycle).otherwise(F.col("text")).alias(text_col))


def longest(runs: str = "runs") -> Column:
    """The run of greatest length, of those the first, of those the one of smallest period; null without runs."""
    key = F.transform(F.col(runs), lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(key)
