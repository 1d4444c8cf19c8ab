"""What raw days really hold: every value read once, rows counted, content digested.

A footer tells how many rows a file should have. Here the pages themselves are read, checksums
included, with damaged files passed over, so that one damaged page costs its day and no other.
The same pass gives an order-free digest of each day, by which a later build sees what has changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.operators.days import day_range
from panelloom.session import settings
from panelloom.sources.footers import audit_days, audit_files

UNREADABLE = "raw data cannot be read"
LACKING = "raw data lacks columns"
# Reading goes on behind a damaged file; pages are held against the checksums that Spark wrote with them.
LENIENT = {"spark.sql.files.ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true"}


def day_folder_of(raw: DataFrame) -> str | None:
    """The folder whose ``dateid=N`` folders ``raw`` is read from, or None if it is read from anything else."""
    files = raw.inputFiles()
    roots = {f.split("/dateid=")[0] for f in files}
    return roots.pop() if len(roots) == 1 and all("/dateid=" in f for f in files) else None


def digest(columns: Sequence[str]) -> list:
    """Aggregates that together tell sets of rows apart, whatever the order and the files the rows are in.

    Both halves of a 64-bit row hash are summed, which two billion rows a group cannot overflow.
    """
    row = F.xxhash64(*sorted(columns))
    low = F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.sum(F.shiftrightunsigned(row, 32))
    return [F.count(F.lit(1)).alias("rows"), F.concat_ws("-", F.lower(F.hex(high)), F.lower(F.hex(low))).alias("digest")]


def day_contents(spark: SparkSession, folder: str, schema: T.StructType, start: int, end: int) -> DataFrame:
    """``dateid, rows, digest`` of what can be read of the days of ``[start, end)``; one row a day, collected at once.

    A store that fails while a file is read counts as damage here: the day comes out as an error, to be built later.
    """
    with settings(spark, LENIENT):
        try:
            found = {f.name: f for f in spark.read.option("basePath", folder).parquet(folder).schema.fields}
        except Exception:  # not one file has a footer
            found = {}
        # Types as they are stored, for the columns that the build reads.
        wanted = T.StructType([found.get(f.name, f) for f in schema.fields])
        stored = spark.read.schema(wanted).parquet(folder).where(F.col("dateid").between(start, end - 1))
        names = [f.name for f in schema.fields if f.name != "dateid"]
        rows = stored.groupBy("dateid").agg(*digest(names)).collect()
    return spark.createDataFrame([tuple(r) for r in rows], "dateid int, rows bigint, digest string")


def audit_contents(
    spark: SparkSession, folder: str, schema: T.StructType, start: int, end: int
) -> tuple[DataFrame, dict[int, str]]:
    """The contents of the days of ``[start, end)``, and why some of them cannot be built from.

    A day is bad if a footer cannot be parsed, a file lacks a column, or fewer rows can be read than
    the footers promise.
    """
    columns = [f.name for f in schema.fields if f.name != "dateid"]
    audit = audit_days(audit_files(spark, folder, days=(start, end), columns=columns), day_range(spark, start, end), lacking=True)
    contents = day_contents(spark, folder, schema, start, end)
    both = audit.where("exists").join(contents.select("dateid", F.col("rows").alias("read")), "dateid", "left")
    short = ~F.col("readable") | (F.coalesce("read", F.lit(0)) != F.col("rows"))
    why = F.when(short, F.lit(UNREADABLE)).when(F.col("lacking") > 0, F.lit(LACKING))
    bad = {r["dateid"]: r["why"] for r in both.select("dateid", why.alias("why")).where("why IS NOT NULL").collect()}
    return contents, bad
