"""Counts of rows and of present values from column-chunk statistics: footers are read, data is not.

A parquet footer has, for every column chunk, its number of rows and mostly its number of NULLs. Where a
writer left the latter out, that file alone is read, and of its columns only those in question. Missing
must be stored as NULL, as this package writes it: a footer does not count NaN.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sources.footers import day_files, parsed_footer
from panelloom.sources.panel import day_of_path

COUNTS = "path string, rows bigint, feature string, present bigint"


def footer_counts_of(path: str, columns: Sequence[str]) -> list[tuple[str, int, str | None, int | None]]:
    """Rows of a file, and present values of each column; None where a chunk does not tell. A column that the file has
    not is wholly missing. One row without a column tells the rows alone."""
    footer = parsed_footer(path)
    if footer is None:
        raise ValueError(f"{path} is not parquet")
    place = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
    out: list[tuple[str, int, str | None, int | None]] = [(path, footer.num_rows, None, None)]
    for name in columns:
        present: int | None = 0
        for g in range(footer.num_row_groups if name in place else 0):
            chunk = footer.row_group(g).column(place[name])
            known = chunk.statistics is not None and chunk.statistics.has_null_count
            present = None if present is None or not known else present + chunk.num_values - chunk.statistics.null_count
        out.append((path, footer.num_rows, name, present))
    return out


def file_counts(spark: SparkSession, folder: str, columns: Sequence[str] = (), days: tuple[int, int] | None = None) -> DataFrame:
    """``dateid, path, rows, feature, present``: one row a file without a feature, and one for each of ``columns``."""
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for path in batch.column(0).to_pylist() for r in footer_counts_of(path, names)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], ["path", "rows", "feature", "present"])

    found = day_files(spark, folder, days=days).mapInArrow(run, COUNTS)
    return found.select(day_of_path(F.col("path")).alias("dateid"), "path", "rows", "feature", "present")


def stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``dateid, rows`` of every stored day."""
    return file_counts(spark, folder).groupBy("dateid").agg(F.sum("rows").alias("rows")).where("rows > 0")


def stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """Number of days with rows, and of rows."""
    return stored_rows(spark, folder).agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def stored_present(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """``dateid, feature, rows, present`` of every stored day and column."""
    counts = file_counts(spark, folder, columns).where("feature IS NOT NULL")
    untold = sorted({(r["path"], r["feature"]) for r in counts.where("present IS NULL").select("path", "feature").collect()})
    known = counts.where("present IS NOT NULL").select("dateid", "feature", "rows", "present")
    if untold:  # one name a file whose writer left statistics out
        paths, names = sorted({p for p, _ in untold}), sorted({f for _, f in untold})
        read = spark.read.parquet(*paths).select(F.col("_metadata.file_path").alias("path"), *names)
        wide = read.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), *(F.count(n).alias(n) for n in names))
        long = wide.unpivot(["path", "rows"], names, "feature", "present")
        file = lambda c: F.element_at(F.split(c, "/"), -1)
        asked = counts.where("present IS NULL").select(file("path").alias("file"), F.col("dateid").alias("day"), F.col("feature").alias("asked"))
        again = long.join(asked, (file("path") == F.col("file")) & (F.col("feature") == F.col("asked")) & day_of_path(F.col("path")).eqNullSafe(F.col("day")))
        known = known.unionByName(again.select(F.col("day").alias("dateid"), "feature", "rows", "present"))
    return known.groupBy("dateid", "feature").agg(F.sum("rows").alias("rows"), F.sum("present").alias("present"))


def stored_all_missing(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Per column, whether no stored day has a value: rows ``feature, all_missing``."""
    sums = stored_present(spark, folder, columns).groupBy("feature").agg((F.sum("present") == 0).alias("all_missing"))
    return sums
