"""Partition layout helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int, fence_cols: list[str] | None = None) -> DataFrame:
    """Deal the rows round-robin to ``partitions`` tasks, for CPU-heavy work on
    an input that the scan cannot split (one file of one row group).

    An explicit call: the caller states the number, nothing is chosen here. It
    shuffles every selected column. ``fence_cols`` (default: all) are fenced, so
    no filter on a value computed from them is pushed back into the scan tasks.
    """
    return fence(df.repartition(partitions), fence_cols)


def fence(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Evaluate ``cols`` (default: all columns) once, before any later filter.

    Catalyst pushes a filter on a computed column below the projection that
    computes it, substituting the expression: a filter on an extracted
    section would rerun the whole regex cascade inside the filter (and, on
    a small input, in the single scan task before ``spread``). Filters do
    not cross a Generate on its generated columns, so ``cols`` are passed
    through a one-row ``inline``, which stays in whole-stage codegen. The
    other columns pass through as the Generate's child output, which
    column pruning can still drop.
    """
    cols = list(df.columns) if cols is None else list(cols)
    rest = [c for c in df.columns if c not in cols]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    out = df.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.array(row)))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def stage(df: DataFrame, name: str = "batch") -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Used for the update batch of a keyed merge: it is computed once however
    often the merge reads it, its lineage starts at the written files, and
    the planner sees its real size. A batch below the broadcast threshold
    is then broadcast, so the (large) old table is scanned and filtered
    without being shuffled; a larger batch gets a sort-merge join.
    """
    from quire.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Gives freed memory back to the system. A Python worker waits for its next task
    beside the executor's heap; what its allocators keep of past arrays counts there."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim is not None:
        trim(0)


def lean(run):
    """``run``, a function for ``mapInArrow``, with ``give_back`` when a task ends."""
    def out(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return out


def lean_call(run, *args):
    """What ``run`` gives, as for a group of ``applyInPandas``, with ``give_back`` after it."""
    try:
        return run(*args)
    finally:
        give_back()


def remove_staged(spark: SparkSession, application_id: str) -> bool:
    """Housekeeping: delete the staged batches of one job, named by its
    application id, from the shared checkpoint folder. They must outlive the
    job's final write, so call this when the job has ended. Returns whether
    there was anything to remove."""
    from quire.session import scratch_path

    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"staged/{application_id}"))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(root) and fs.delete(root, True))
