"""Session helpers: where shared scratch data lives and how intermediates are pinned."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is used, but only in local mode: on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="panelloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """Session settings for the jobs that are run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet, and it goes when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Used where two branches must see the very same rows, e.g. after a sampled
    range partitioning, and where a lost executor must not change them.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Bytes of input that one task of a main shuffle should get.
TASK_BYTES = 128 * 1024 * 1024


# Estimates from here on stand for a size that is not known.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(plan) -> int | None:
    """Bytes of a logical plan's result by the optimizer's estimates, but for joins; None if some input tells no size.

    Without statistics the optimizer multiplies the sides of a join. The joins of this package look
    up one row for each of the larger side's, so the sum of both sides is the better guess.
    """
    children = plan.children()
    parts = [children.apply(i) for i in range(children.size())]
    own = int(plan.stats().sizeInBytes())
    if not parts:
        return own if own < UNKNOWN_BYTES else None
    inputs = [estimated_bytes(p) for p in parts]
    if None in inputs:
        return None
    if len(parts) > 1:
        return sum(inputs)
    before = int(parts[0].stats().sizeInBytes())
    return inputs[0] * own // max(1, before)


def partition_count(df: DataFrame, task_bytes: int = TASK_BYTES, size: int | None = None) -> int:
    """Partitions for a main shuffle of ``df``: one for each ``task_bytes`` of its ``size``, and at least
    ``spark.sql.shuffle.partitions``. Without a size the optimizer's estimate serves, and where there is none either
    the setting stands alone."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df._jdf.queryExecution().optimizedPlan()) if size is None else size
    return least if size is None else max(least, -(-size // task_bytes))


def spread(df: DataFrame, *keys: str, task_bytes: int = TASK_BYTES, rows: int | None = None, columns: int | None = None) -> DataFrame:
    """Shuffle by ``keys`` into as many partitions as the input's size asks for.

    Adaptive execution merges partitions by their compressed size. Sparse panels
    compress so well that the work on them would end up in a handful of tasks, so the
    count is fixed here, but from the data. The optimizer's estimate counts compressed files, and not the rows that
    an ``explode`` adds; ``rows`` is for callers that know them, with the ``columns`` that a sort behind the shuffle
    carries, if more than those of ``df``.
    """
    size = None if rows is None else rows * 8 * (1 + (columns or len(df.columns)))
    return df.repartition(partition_count(df, task_bytes, size), *keys)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys where a missing key equals a missing key; the right keys are dropped."""
    theirs = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(theirs)
    condition = [left[k].eqNullSafe(right[theirs[k]]) for k in keys]
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*theirs.values())
