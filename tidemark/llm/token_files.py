"""Token-id files (9): directly addressable codes, random access to any token without decoding a block.

A file holds the ids of consecutive documents.  Level 0 has the low byte of every id and a bitmap that says which ids
go on; level 1 has the next byte of those only, and so on.  A rank directory counts the set bits before every 512th, so
the place of an id in the next level comes from one directory entry and one popcount.

Layout, little-endian: ``MAGIC``; uint32 levels; uint64 documents, tokens, bytes of the names; per level uint64 length;
then the documents' names (an Arrow stream) and starts (uint64, documents + 1 of them); then per level its bytes, its bitmap (bits in order, padded to whole blocks of
64 bytes) and its directory (uint64 per block).
"""

from __future__ import annotations

import gc
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm import _bpe
from tidemark.llm._common import open_folder, pick, sent, shared_folder, slices, staged, texts_of

MAGIC = b"TKDAC001"
BLOCK = 512
#: a file is closed at the first document end beyond so many tokens
FILE_TOKENS = 4_000_000


def pack(ids: np.ndarray, starts: np.ndarray, names: pa.Array) -> bytes:
    """A file of ids (uint32), the documents' starts with the end of the last, and their names."""
    levels, rest = [], np.ascontiguousarray(ids, "<u4")
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.r_[bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)]
        ranks = np.r_[0, np.cumsum(np.bitwise_count(bits.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint64))][:-1] if len(bits) else []
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), np.asarray(ranks, "<u8").tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    batch = pa.RecordBatch.from_arrays([names], ["name"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    named = sink.getvalue().to_pybytes()
    head = MAGIC + struct.pack(f"<IQQQ{len(levels)}Q", len(levels), len(starts) - 1, len(ids), len(named), *(n for n, *_ in levels))
    return b"".join([head, named, np.asarray(starts, "<u8").tobytes(), *(part for _, *parts in levels for part in parts)])


class TokenFile:
    """A file opened for reading; only the bytes asked for are read."""

    def __init__(self, source):
        self.source = source
        head = self._read(0, len(MAGIC) + 28)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("no token-id file")
        count, self.documents, self.tokens, self.name_bytes = struct.unpack_from("<IQQQ", head, len(MAGIC))
        at = len(MAGIC) + 28
        self.sizes = struct.unpack(f"<{count}Q", self._read(at, 8 * count))
        self.names_at = at + 8 * count
        self.starts_at = at = self.names_at + self.name_bytes
        at += 8 * (self.documents + 1)
        self.places = []
        for n in self.sizes:
            bits = -(-n // BLOCK) * (BLOCK // 8)
            self.places.append((at, at + n, at + n + bits))
            at += n + bits + 8 * (bits // (BLOCK // 8))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def starts(self) -> np.ndarray:
        return np.frombuffer(self._read(self.starts_at, 8 * (self.documents + 1)), "<u8").astype(np.int64)

    def names(self) -> pa.Array:
        return pa.ipc.open_stream(self._read(self.names_at, self.name_bytes)).read_all().column("name").combine_chunks()

    def _rank(self, level: int, at: int) -> int:
        """Set bits before place ``at`` of a level: a directory entry and the bits of one block."""
        if at >= self.sizes[level]:
            return self.sizes[level + 1] if level + 1 < len(self.sizes) else 0
        _, bits, ranks = self.places[level]
        block = at // BLOCK
        before = struct.unpack("<Q", self._read(ranks + 8 * block, 8))[0]
        raw = np.frombuffer(self._read(bits + block * (BLOCK // 8), BLOCK // 8), np.uint8)
        return before + int(np.unpackbits(raw, bitorder="little")[: at % BLOCK].sum())

    def token(self, at: int) -> int:
        """The id at any place."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = 0
        for level in range(len(self.sizes)):
            value |= self._read(self.places[level][0] + at, 1)[0] << 8 * level
            if not self._read(self.places[level][1] + at // 8, 1)[0] >> at % 8 & 1:
                break
            at = self._rank(level, at)
        return value

    def span(self, begin: int, end: int) -> np.ndarray:
        """The ids of places ``begin`` to ``end``, read level by level."""
        out = np.zeros(end - begin, np.uint32)
        rows = np.arange(end - begin)
        for level in range(len(self.sizes)):
            if not len(rows):
                break
            data, bits, _ = self.places[level]
            out[rows] |= np.frombuffer(self._read(data + begin, end - begin), np.uint8).astype(np.uint32) << np.uint32(8 * level)
            raw = np.frombuffer(self._read(bits + begin // 8, (end + 7) // 8 - begin // 8), np.uint8)
            more = np.unpackbits(raw, bitorder="little")[begin % 8 :][: end - begin].astype(bool)
            begin = self._rank(level, begin)
            rows, end = rows[more], begin + int(more.sum())
        return out


def write_tokens(docs: DataFrame, path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> tuple[str, DataFrame]:
    """Encode every whole text, append ``end_id`` to each and write files in ascending order of the id column.

    Returns the folder and the written files: ``(file, part, place, first_id, documents, tokens, base)``, ``base`` being
    the tokens of all files before.  Files have names of their own, so a task that runs twice leaves an unnamed file
    and no double rows.  Null and empty texts have the end id only; rows with a null id come first; rows that share an
    id keep an order by text; an empty table writes no file.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"part int, place int, file string, first_id {kind}, documents long, tokens long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        vocabulary, encode, target = _bpe.vocabulary(path), _bpe.library(path), open_folder(folder)
        part, place = TaskContext.get().partitionId(), 0
        end = _bpe.packed([end_id])
        ids: list[bytes] = []
        names: list = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, names, held, place
            file = f"{part:06d}-{place:05d}-{uuid.uuid4().hex}.dac"
            starts = np.cumsum([0, *map(len, ids)]) // 4
            with target.create(file) as out:
                out.write(pack(np.frombuffer(b"".join(ids), "<u4"), starts, pa.array(names, arrow.field("first_id").type)))
            row = pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, place, file, names[0], len(names), int(starts[-1])), arrow)], schema=arrow)
            ids, names, held, place = [], [], 0, place + 1
            return row

        for batch in batches:
            for cut in slices(batch, "text") if batch.num_rows else ():
                flat, begins = vocabulary.encode(texts_of(cut, "text"), encode)
                for name, a, b in zip(cut.column("doc_id").to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                    ids.append(flat[a:b].tobytes() + end)
                    names.append(name)
                    held += len(ids[-1]) // 4
                    if held >= FILE_TOKENS:
                        yield close()
        if ids:
            yield close()

    sorted_rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    files = staged(sent(sorted_rows).mapInArrow(run, schema))
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file of millions of tokens
    bases = files.select("part", "place", "tokens").select("part", "place", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return folder, files.join(bases, ["part", "place"])


def _stored(folder: str, files: Iterable[tuple[str, int]]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Documents of files: names, starts over all files with the end of the last, ids; about a million ids at a time."""
    source = open_folder(folder)
    for file, base in files:
        with source.open(file) as raw:
            stored = TokenFile(raw)
            starts, names = stored.starts(), stored.names()
            begin = 0
            while begin < stored.documents:
                end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + 1_000_000)) - 1)
                yield names.slice(begin, end - begin), base + starts[begin : end + 1], stored.span(int(starts[begin]), int(starts[end]))
                begin = end


def _read(folder: str, files: DataFrame, columns, fields: str) -> DataFrame:
    kind = files.schema["first_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, start long, {fields}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, starts, ids in _stored(folder, zip(batch.column("file").to_pylist(), batch.column("base").to_pylist())):
                yield pa.RecordBatch.from_arrays([names, pa.array(starts[:-1], pa.int64()), *columns(starts - starts[0], ids)], schema=arrow)

    # a task per file: sizes of the list's own rows say nothing of the work
    return sent(files.select("file", "base").repartition(max(1, files.count()), "file")).mapInArrow(run, schema)


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """All documents of written files: ``(doc_id, start, ids array<int>)``; ``start`` counts over all files."""
    return _read(folder, files, lambda begins, ids: [pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32)))], "ids array<int>")


def checksums(folder: str, files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of all stored documents, to verify files without moving their ids."""

    def columns(begins: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        raw, at = memoryview(ids.astype("<u4").tobytes()), (4 * begins).tolist()
        return [pa.array(np.diff(begins), pa.int64()), pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64())]

    return _read(folder, files, columns, "n_tokens long, ids_crc32 long")
