"""Token counts (6): pieces once per distinct pre-token, joined to per-document frequencies, summed without ids."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm import _bpe
from tidemark.llm._common import pick, sent, slices, texts_of

#: a block of documents: at most so many bytes of text (or one slice of them) and so many rows
BLOCK_BYTES = 24_000_000
BLOCK_ROWS = 65_536
#: groups of pre-tokens by hash; a task knows the distinct ones of a group at a time
BUCKETS = 1024
#: sums held by a task before they are handed on
HELD_SUMS = 2_000_000
#: one entry of a frequency list; more than 255 occurrences take several entries
ENTRY = np.dtype([("doc", "<u2"), ("n", "u1")])


class _Codes(dict):
    """Numbers of a block's pre-tokens from 1; 0 for those that the vocabulary holds as one piece."""

    def __init__(self, whole: frozenset[str]):
        self.whole, self.words = whole, []

    def __missing__(self, word: str) -> int:
        if word in self.whole:
            code = 0
        else:
            self.words.append(word)
            code = len(self.words)
        self[word] = code
        return code


def _whole_words(path: str) -> frozenset[str]:
    """Pre-tokens of one piece: special strings, and tokens that the library encodes as themselves."""

    def text(token: bytes) -> str:
        try:
            return token.decode()
        except UnicodeDecodeError:
            return ""

    v = _bpe.vocabulary(path)
    texts = [t for k, token in enumerate(v.tokens) if k not in v.specials.values() and (t := text(token))]
    counts = map(len, _bpe.library(path)(texts))
    return frozenset(t for t, n in zip(texts, counts) if n == 4) | frozenset(v.specials)


class _Block:
    """Documents whose pre-tokens leave a task together."""

    def __init__(self, number: int, whole: frozenset[str]):
        self.number, self.codes = number, _Codes(whole)
        self.ids, self.counted, self.sizes, self.pairs = [], [], [], []

    def add(self, name, text: str, vocabulary: _bpe.Vocabulary) -> None:
        one = 0
        for words in vocabulary.pieces(text):
            found = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
            rest = found[found > 0]
            one += len(found) - len(rest)
            self.pairs.append((rest << 16) | len(self.ids))
        self.ids.append(name)
        self.counted.append(one)
        self.sizes.append(len(text.encode()))

    def rows(self) -> Iterator[tuple]:
        """A row per bucket of pre-tokens with lengths, text and entries, and one for the documents."""
        pairs, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]), return_counts=True)
        times = -(-n // 255)
        if len(n) and times.max() > 1:
            last = np.cumsum(times) - 1
            pairs, rest = np.repeat(pairs, times), n - 255 * (times - 1)
            n = np.full(len(pairs), 255)
            n[last] = rest
        entries = np.empty(len(pairs), ENTRY)
        entries["doc"], entries["n"] = pairs & 0xFFFF, n
        words = [w.encode() for w in self.codes.words]
        begins = np.searchsorted(pairs >> 16, np.arange(1, len(words) + 2))
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            chosen = order[cuts[k] : cuts[k + 1]].tolist()
            own = [words[w] for w in chosen]
            yield (k, self.number, np.array([(len(w), begins[c + 1] - begins[c]) for c, w in zip(chosen, own)], "<u4").tobytes(), b"".join(own), b"".join([entries[begins[c] : begins[c + 1]].tobytes() for c in chosen]), None, None, None)
        yield self.number % BUCKETS, self.number, None, None, None, self.ids, self.counted, self.sizes


def _frequencies(rows: DataFrame, path: str, kind: str) -> DataFrame:
    schema = StructType.fromDDL(f"bucket int, block long, lengths binary, words binary, entries binary, ids array<{kind}>, counted array<long>, n_bytes array<long>")
    arrow = to_arrow_schema(schema)

    def made(block: _Block) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block.rows()), arrow)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        vocabulary, whole = _bpe.vocabulary(path), _whole_words(path)
        number, held = TaskContext.get().partitionId() << 20, 0
        block = _Block(number, whole)
        for batch in (part for w in batches for part in slices(w, "text")):
            for name, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                if block.ids and (held + len(text) > BLOCK_BYTES or len(block.ids) == BLOCK_ROWS):
                    yield made(block)
                    number, held = number + 1, 0
                    block = _Block(number, whole)
                block.add(name, text, vocabulary)
                held += len(text)
        if block.ids:
            yield made(block)

    return sent(rows).mapInArrow(run, schema)


def _sums(found: DataFrame, path: str, kind: str) -> DataFrame:
    """Pieces by block and document as far as one task saw them; the blocks' own rows pass through."""
    schema = StructType.fromDDL(f"block long, docs binary, sums binary, ids array<{kind}>, counted array<long>, n_bytes array<long>")
    arrow = to_arrow_schema(schema)

    def flush(keys: list[np.ndarray], sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, np.concatenate(sums)).astype("<u8")
        block, doc = key >> 16, (key & 0xFFFF).astype("<u2")
        cuts = np.r_[np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(key)]
        parts = [(int(block[a]), doc[a:b].tobytes(), total[a:b].tobytes(), None, None, None) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*parts), arrow)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        encode = _bpe.library(path)
        keys, sums, held, now = [], [], 0, None
        pieces: dict[bytes, int] = {}
        for batch in batches:
            own = [k for k, x in enumerate(batch.column("lengths").is_null().to_pylist()) if x]
            if own:
                heads = batch.take(pa.array(own))
                blank = pa.nulls(len(own), pa.binary())
                yield pa.RecordBatch.from_arrays([heads.column("block"), blank, blank, *(heads.column(c) for c in ("ids", "counted", "n_bytes"))], schema=arrow)
            for bucket, block, lengths, raw, entries in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "lengths", "words", "entries"))):
                if lengths is None:
                    continue
                if bucket != now:
                    now, pieces = bucket, {}
                table = np.frombuffer(lengths, "<u4").reshape(-1, 2).astype(np.int64)
                ends = np.cumsum(table[:, 0]).tolist()
                words = [raw[a:b] for a, b in zip([0, *ends], ends)]
                if new := [w for w in words if w not in pieces]:
                    pieces.update(zip(new, [len(x) // 4 for x in encode([w.decode() for w in new])]))
                n = np.fromiter(map(pieces.__getitem__, words), np.int64, len(words))
                each = np.frombuffer(entries, ENTRY)
                keys.append((block << 16) | each["doc"].astype(np.int64))
                sums.append(np.repeat(n, table[:, 1]) * each["n"])
                held += len(each)
                if held > HELD_SUMS:
                    yield from flush(keys, sums)
                    keys, sums, held = [], [], 0
        yield from flush(keys, sums)

    return sent(found).mapInArrow(run, schema)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text as the tokenizers library counts them, without begin, end or added special tokens.

    Each task splits blocks of documents into pre-tokens.  A pre-token that the fixed vocabulary holds as one piece
    counts at once; the others leave with their documents' frequencies, packed by block and bucket of pre-tokens.  All
    rows of a bucket meet in one task, which gives every distinct pre-token to the library one time, joins its pieces
    to the frequencies and hands on sums by document.  A frequent pre-token has one list per block, so none is hot.

    Returns ``(id, n_bytes, n_tokens)``, one row per input row; null and empty texts have 0 of both; null and repeated
    ids are kept as they are; an empty table gives an empty table.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    met = _frequencies(rows, path, kind).repartition("bucket").sortWithinPartitions("bucket")

    def add(table: pa.Table) -> pa.Table:
        own = table.column("ids").is_null().to_pylist().index(False)
        total = np.array(table.column("counted")[own].as_py(), np.int64)
        for docs_, sums in zip(table.column("docs").to_pylist(), table.column("sums").to_pylist()):
            if docs_ is not None:
                total[np.frombuffer(docs_, "<u2")] += np.frombuffer(sums, "<u8").astype(np.int64)
        ids = table.column("ids")[own].values
        return pa.table({"doc_id": ids, "n_bytes": table.column("n_bytes")[own].values, "n_tokens": pa.array(total, pa.int64())})

    return _sums(met, path, kind).groupBy("block").applyInArrow(add, f"doc_id {kind}, n_bytes long, n_tokens long")
