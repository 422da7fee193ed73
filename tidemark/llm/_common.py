"""Helpers of the operators: column picking, Arrow batches cut by bytes, files in the shared folder."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.staging import staged, staging_dir

#: bytes of text that a Python task holds as Python objects at one time
SLICE_BYTES = 2_000_000
#: bytes of a batch between Spark and Python at most
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000
#: Spark's own value, as it may be written; any other value is the user's and stays
STANDARD_LIMITS = ("67108864", "67108864b", "64m", "64MB")


#: what this worker process keeps between tasks, and the operator it was kept for
_CACHES: list = []
_OWNER: list[str] = [""]


def worker_cache(make: Callable) -> Callable:
    """Keep what ``make`` returns between tasks of one operator; the next operator's first task drops it."""
    kept = functools.lru_cache(maxsize=2)(make)
    _CACHES.append(kept)
    return kept


def settle(owner: str) -> None:
    """Give back memory of earlier tasks; tables that another operator kept go with it."""
    if _OWNER[0] != owner:
        for cache in _CACHES:
            cache.cache_clear()
        _OWNER[0] = owner
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def pick(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra columns can't clash with them."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in named.items()])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``most`` bytes of ``column``, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = held = 0
    for at, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: str | StructType, cut_by: str | None = None, most: int = SLICE_BYTES) -> DataFrame:
    """``make`` runs once in a task and gives a function from a batch to columns (or None for no rows); batches are cut at ``most`` bytes of a column."""
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, owner = to_arrow_schema(out), make.__module__

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(owner)
        work = make()
        for batch in batches:
            for part in slices(batch, cut_by, most) if cut_by else (batch,):
                if part.num_rows and (columns := work(part)) is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in arrow], schema=arrow)

    return sent(df).mapInArrow(run, out)


_SENT: set[str] = set()


def sent(df: DataFrame) -> DataFrame:
    """The frame, after its session's executors have been given this package, once per application.

    Batches for Python are bounded by bytes too: ten thousand long texts would not fit.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT) in STANDARD_LIMITS:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SENT:
        package = Path(__file__).resolve().parents[1]
        held = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(held, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(held))
        _SENT.add(context.applicationId)
    return df


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts with null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the folder that the driver and all executors share."""
    return f"{staging_dir(spark)}/{kind}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Folder:
    """A folder of the shared store as tasks see it."""

    fs: pafs.FileSystem
    path: str

    def create(self, name: str):
        self.fs.create_dir(self.path, recursive=True)
        return self.fs.open_output_stream(f"{self.path}/{name}")

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.path}/{name}")


def open_folder(uri: str) -> Folder:
    """Any store that pyarrow reads: local and mounted paths, ``file:``, ``hdfs:``, ``s3:`` and ``gs:``."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    system, path = pafs.FileSystem.from_uri(uri)
    return Folder(system, path)
