"""File audit: existence, readability, rows and columns of parquet files, from footers only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sources.panel import DAY_FOLDER, day_of_path

AUDIT = "path string, readable boolean, rows bigint, cols bigint, names array<string>"


def parsed_footer(path: str) -> pq.FileMetaData | None:
    """The footer, or None if it cannot be parsed. A store that cannot be reached raises, and Spark tries the task again."""
    filesystem, name = pafs.FileSystem.from_uri(path)
    with filesystem.open_input_file(name) as source:
        size = source.size()
        source.seek(max(0, size - 8))
        length = int.from_bytes(source.read()[:4], "little")
        source.seek(max(0, size - 8 - length))
        tail = source.read()
    # The bytes are here; what fails from now on is their content.
    try:
        return pq.read_metadata(pa.BufferReader(tail))
    except (pa.ArrowException, OSError):
        return None


def read_footer(path: str) -> tuple[bool, int, list[str]]:
    """Readable, rows, names of columns."""
    footer = parsed_footer(path)
    if footer is None:
        return False, 0, []
    return True, footer.num_rows, footer.schema.to_arrow_schema().names


def footer_counts(path: str) -> tuple[bool, int, int]:
    """Readable, rows, columns."""
    readable, rows, names = read_footer(path)
    return readable, rows, len(names)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = [read_footer(p) for p in paths]
        yield pa.record_batch(
            {
                "path": pa.array(paths, pa.string()),
                "readable": pa.array([f[0] for f in found], pa.bool_()),
                "rows": pa.array([f[1] for f in found], pa.int64()),
                "cols": pa.array([len(f[2]) for f in found], pa.int64()),
                "names": pa.array([f[2] for f in found], pa.list_(pa.string())),
            }
        )


def day_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", days: tuple[int, int] | None = None) -> DataFrame:
    """``path`` of every file, of half-open ``days`` only if given. Names are listed, nothing is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path")
    )
    if days is None:
        return files
    day = day_of_path(F.col("path"))
    return files.where((day >= days[0]) & (day < days[1]))


def audit_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.parquet",
    days: tuple[int, int] | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """One row per file; a file that is not parquet is reported, not raised. ``lacking`` counts the ``columns`` it has not.

    Only names are listed by Spark; the tasks read footers, and with ``days`` (half-open)
    only those of these days. ``cols`` counts the ``dateid`` that a day folder stands for.
    """
    found = day_files(spark, folder, pattern, days).mapInArrow(_read_footers, AUDIT)
    in_folder = (F.regexp_extract("path", DAY_FOLDER, 1) != "") & F.col("readable")
    return found.select(
        day_of_path(F.col("path")).alias("dateid"),
        "path",
        "readable",
        "rows",
        (F.col("cols") + F.when(in_folder, 1).otherwise(0)).alias("cols"),
        F.size(F.array_except(F.array(*map(F.lit, columns)).cast("array<string>"), "names")).alias("lacking"),
    )


def audit_days(files: DataFrame, requested: DataFrame, lacking: bool = False) -> DataFrame:
    """Per requested day: ``exists, readable, rows, cols`` over all its files.

    ``cols`` is that of the narrowest file and ``mixed`` tells whether widths differ; with ``lacking`` so
    many of the columns asked for are not in some file.
    """
    found = files.groupBy("dateid").agg(
        F.bool_and("readable").alias("readable"),
        F.sum("rows").alias("rows"),
        F.min("cols").alias("cols"),
        (F.min("cols") != F.max("cols")).alias("mixed"),
        F.max("lacking").alias("lacking"),
    )
    joined = requested.join(found, "dateid", "left")
    readable = F.coalesce("readable", F.lit(False))
    return joined.select(
        "dateid",
        F.col("readable").isNotNull().alias("exists"),
        readable.alias("readable"),
        F.when(readable, F.col("rows")).otherwise(0).alias("rows"),
        F.when(readable, F.col("cols")).otherwise(0).alias("cols"),
        F.coalesce("mixed", F.lit(False)).alias("mixed"),
        *([F.when(readable, F.col("lacking")).otherwise(0).alias("lacking")] if lacking else []),
    )


def usable(audit: DataFrame) -> DataFrame:
    return audit.where("exists AND readable AND rows > 0")
