"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import scratch_path

#: Text that a Python task works on at once; a longer single text is still taken whole.
CHUNK_BYTES = 4 << 20
#: Rows of whole texts that go to Python at once, for ``arrow_rows``; the JVM and the worker both hold several batches.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and whole text alone, as ``doc_id`` and ``text``; a missing text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the checksum of its id; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def hash_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by the hash of a key: a filter, at whatever size.

    Where keys repeat there may be more; who collects from it sets a limit of twice ``rows`` too.
    """
    if total <= rows:
        return df
    share = int(rows / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < share)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Rows that go to Python at once, for what is written inside; long rows need small batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` as a table in the shared folder, written with ``rows`` rows going to Python at once."""
    path = scratch_path(df.sparkSession, name)
    with arrow_rows(df.sparkSession, rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, beside the JVM."""
    gc.collect()
    trim()


def trim() -> None:
    """The same without a search for cycles, which takes longer than all else; for use in the midst of a task."""
    pa.default_memory_pool().release_unused()
    malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if malloc_trim is not None:
        malloc_trim(0)


def gathered(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they hold ``size`` bytes of text."""
    held, used = [], 0
    for batch in batches:
        held.append(batch)
        used += column(batch, text).nbytes
        if used >= size:
            yield pa.concat_batches(held)
            held, used = [], 0
    if held:
        yield pa.concat_batches(held)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most ``size`` bytes of text, or one row."""
    lengths = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(zero_copy_only=False)
    start = used = 0
    for i, n in enumerate(lengths.tolist()):
        if used and used + n > size:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += n
    if start < batch.num_rows:
        yield batch.slice(start)


def per_chunk(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], size: int = CHUNK_BYTES):
    """A ``mapInArrow`` function: ``make`` runs once a task, what it returns once a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in chunks(batch, size=size):
                yield work(part)

    return run


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever its letters' case."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
