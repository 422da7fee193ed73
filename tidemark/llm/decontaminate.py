"""Benchmark decontamination (2): a broadcast set of n-gram hashes, a scan of token windows, verified hits."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import map_arrow, pick, texts_of

#: Fixed value: words of the contract, runs of ASCII letters and digits and of anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: test texts of one broadcast block; a larger benchmark is scanned in several blocks
BLOCK_BYTES = 32_000_000
#: an odd multiplier of the window hash
BASE = np.uint64(0x9E3779B97F4A7C15)

_SEPARATORS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_PLAIN = regex.compile(WORD)


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_SEPARATORS).split()


def _hashed(columns: Iterable[np.ndarray]) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of windows, given the first words of all, then the second words and so on."""
    out = np.uint64(0)
    for numbers in columns:
        out = out * BASE + numbers
    return out


class TestSet:
    """Windows of a block of test items: word numbers, window hashes by length, and the items of each window."""

    __test__ = False

    def __init__(self, items: list[tuple], window: int):
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for name, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text or "")]
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(words[at : at + size]), set()).add(name)
        self.items = found
        self.hashes = {}
        for size in {len(w) for w in found}:
            windows = np.array([w for w in found if len(w) == size], np.uint64)
            self.hashes[size] = np.unique(_hashed(windows.T))

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """Verified occurrences: first word, length, items."""
        numbers = np.fromiter((self.number.get(w, 0) for w in words), np.uint64, len(words))
        if not numbers.any():
            return
        for size, hashes in self.hashes.items():
            if len(words) < size:
                continue
            unknown = np.cumsum(np.r_[0, numbers == 0])
            # windows of known words only
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(starts):
                continue
            hashed = _hashed(numbers[starts + k] for k in range(size))
            at = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
            for start in starts[hashes[at] == hashed].tolist():
                if items := self.items.get(tuple(numbers[start : start + size].tolist())):
                    yield start, size, items


def _blocks(bench: DataFrame, id_col: str, text_col: str, most: int) -> tuple[int, Callable[[int], list[tuple]]]:
    """How many blocks of about ``most`` bytes the test items make, and a function that fetches one of them."""
    rows = pick(bench, item_id=id_col, text=text_col).where("text is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = int(2 * total // most) + 1
    kept = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    return count, lambda block: [(r.item_id, r.text) for r in kept.where(F.col("block") == block).select("item_id", "text").toLocalIterator()]


def find_overlap(docs: DataFrame, bench: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, carry_text: bool = False) -> DataFrame:
    """Windows of test items inside documents: ``(id, n_words, spans array<array<int>>, items array)``, and the text if asked for.

    ``spans`` are disjoint ranges of hit words (first, end), in order; ``items`` are the items whose windows occur,
    each once, without order.  An item of fewer words than a window is one window.  The set
    of a block of test items is broadcast; its size is checked, and a larger benchmark is scanned block by block in one
    pass without a shuffle.  Null and empty texts have no words, null test texts no windows; repeated rows are kept; an
    empty benchmark hits nothing.
    """
    item_kind = bench.schema[item_id].dataType.simpleString()
    rows = pick(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, n_words long, spans array<array<int>>, items array<{item_kind}>"
    found = rows.selectExpr("doc_id", "text", "0L n_words", "cast(array() as array<array<int>>) spans", f"cast(array() as array<{item_kind}>) items")
    count, fetch = _blocks(bench, id_col=item_id, text_col=item_text, most=block_bytes)
    for block in range(count):
        if block == count - 1 and not carry_text:
            schema = schema.replace("text string, ", "")
        found = _scan(found, docs.sparkSession.sparkContext.broadcast(TestSet(fetch(block), window)), schema)
    return found


def _scan(rows: DataFrame, tests, schema: str) -> DataFrame:
    def make():
        test = tests.value

        def work(batch: pa.RecordBatch) -> dict:
            counts, spans, items = [], [], []
            for text, old_spans, old_items in zip(texts_of(batch, "text"), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                words = words_of(text)
                ranges, names = [tuple(s) for s in old_spans], set(old_items)
                for start, size, hit in test.hits(words):
                    ranges.append((start, start + size))
                    names |= hit
                counts.append(len(words))
                spans.append(_united(ranges))
                items.append(list(names))
            return {c: batch.column(c) for c in ("doc_id", "text")} | {"n_words": counts, "spans": spans, "items": items}

        return work

    return map_arrow(rows, make, schema, cut_by="text")


def _united(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([begin, end])
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, remove: str = "documents", **named) -> DataFrame:
    """Rows ``(id, text)`` without test passages; ``remove`` is ``documents`` (those with any hit go) or ``spans``.

    With ``spans`` the text from the first to the last character of every hit range is cut out.
    """
    found = find_overlap(docs, bench, carry_text=True, **named)
    if remove == "documents":
        return found.where(F.size("spans") == 0).select("doc_id", "text")
    if remove != "spans":
        raise ValueError("remove: documents or spans")

    def cut(text: str | None, spans: list[list[int]]) -> str | None:
        if not spans:
            return text
        places = [m.span() for m in _PLAIN.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
        holes = [(places[a][0], places[b - 1][1]) for a, b in spans]
        edges = [0, *(x for hole in holes for x in hole), len(text)]
        return "".join(text[a:b] for a, b in list(pairwise(edges))[::2])

    def make():
        return lambda batch: {"doc_id": batch.column("doc_id"), "text": [cut(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]}

    kind = found.schema["doc_id"].dataType.simpleString()
    return map_arrow(found, make, f"doc_id {kind}, text string", cut_by="text")


def keep_clean(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows without any test window, with all columns, in one pass without a shuffle."""
    fields = docs.schema
    count, fetch = _blocks(bench, id_col=item_id, text_col=item_text, most=block_bytes)
    for block in range(count):
        tests = docs.sparkSession.sparkContext.broadcast(TestSet(fetch(block), window))

        def make(tests=tests):
            test = tests.value

            def work(batch: pa.RecordBatch) -> dict | None:
                kept = batch.filter(pa.array([next(test.hits(words_of(t)), None) is None for t in texts_of(batch, text_col)]))
                return {f.name: kept.column(f.name) for f in fields} if kept.num_rows else None

            return work

        docs = map_arrow(docs, make, fields, cut_by=text_col)
    return docs
