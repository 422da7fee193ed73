"""BPE encoding and decoding (7): speculate greedily, verify all adjacent pairs at once, merge only failing words."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import _bpe
from tidemark.llm._common import map_arrow, pick, texts_of

#: words kept between texts; new words are a small part of the work, so a small table costs little
KEPT_WORDS = 50_000
#: bytes of text encoded and decoded at one time: places of all its tokens are held beside it
SLICE_BYTES = 500_000


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, as the tokenizers library gives them for a byte-level BPE file, special strings as its default.

    Returns ``(id, ids array<int>)``, one row per input row.  A null or empty text has an empty list; null and repeated
    ids are kept as they are; texts of any length are split step by step; an empty table gives an empty table.
    ``path`` must name the file on every executor.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)

    def make():
        gc.disable()
        vocabulary, guess = _bpe.vocabulary(path), _bpe.speculation(path)

        def work(batch: pa.RecordBatch) -> dict:
            ids, begins = vocabulary.encode(texts_of(batch, "text"), guess, KEPT_WORDS)
            return {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32)))}

        return work

    return map_arrow(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>", cut_by="text", most=SLICE_BYTES)


def text_of(ids: list[int] | None, tokens: list[bytes]) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join([tokens[k] for k in ids or () if k is not None and 0 <= k < len(tokens)]).decode("utf-8", "replace")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker: ``(id, ids, text)``, the text decoded from the ids."""
    rows = pick(docs, doc_id=id_col, text=text_col)

    def make():
        gc.disable()
        vocabulary, guess = _bpe.vocabulary(path), _bpe.speculation(path)

        def work(batch: pa.RecordBatch) -> dict:
            ids, begins = vocabulary.encode(texts_of(batch, "text"), guess, KEPT_WORDS)
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32)))
            return {"doc_id": batch.column("doc_id"), "ids": lists, "text": [text_of(ids[a:b].tolist(), vocabulary.tokens) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]}

        return work

    return map_arrow(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string", cut_by="text", most=SLICE_BYTES)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of id lists, special strings included: ``(id, ids, text)``.

    Bytes that are no UTF-8 become U+FFFD and ids outside the vocabulary are left out, as the library does.  A null
    list gives an empty text.
    """
    rows = pick(encoded, doc_id=id_col, ids=ids_col)

    def make():
        tokens = _bpe.vocabulary(path).tokens
        text = lambda ids: text_of(ids, tokens)

        def work(batch: pa.RecordBatch) -> dict:
            lists = batch.column("ids")
            return {"doc_id": batch.column("doc_id"), "ids": lists, "text": [text(ids.values.to_pylist() if ids.is_valid else None) for ids in lists]}

        return work

    return map_arrow(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
