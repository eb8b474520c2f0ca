"""Writes: catalog tables, new table versions, JSON dumps and documents
(G6-G10).

No MERGE-capable format is assumed. A keyed update is computed as the
next version of the table (``quire.operators.upserts``), written to a
fresh location, and the catalog entry is then pointed at it. A job that
reads a table cannot overwrite that same location, and the version
switch is a single metastore call, so a failed write leaves the old
version intact.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from quire import schemas
from quire.operators.joins import flag_exists
from quire.operators.layout import stage
from quire.sinks.versions import VersionedTable, newest_rows


def create_tables(spark: SparkSession, relevance: bool = False, database: str | None = None,
                  location: str | None = None, buckets: int | None = None) -> list[str]:
    """Create ``full_documents`` and ``summaries`` as parquet catalog tables
    when absent (G7). Returns the names that were created.

    With ``buckets``, both tables are bucketed (and sorted) by ``id`` into
    the same number of buckets, so joins between them on ``id`` (the
    summaries report, table-to-table merges) read co-located buckets and
    shuffle neither side."""
    made = []
    tables = schemas.RELEVANCE_TABLES if relevance else schemas.TABLES
    for name, schema in tables.items():
        full = f"{database}.{name}" if database else name
        if spark.catalog.tableExists(full):
            continue
        if buckets:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            where = f" LOCATION '{location}/{name}'" if location else ""
            spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet "
                      f"CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS{where}")
        else:
            kwargs = {"path": f"{location}/{name}"} if location else {}
            spark.catalog.createTable(full, source="parquet", schema=schema, **kwargs)
        made.append(full)
    return made


def _describe(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table, n): rows of each table (E3), as after a clear."""
    from quire.operators.aggregates import row_count

    rows = [row_count(spark.table(n)).select(F.lit(n).alias("table"), "n") for n in names]
    return reduce(DataFrame.unionByName, rows)


def orphans(child: DataFrame, parent: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``child`` whose key is not in ``parent`` (the foreign-key check
    summaries.id -> full_documents.id)."""
    return child.join(parent.select(key), key, "left_anti")


class CheckedTable:
    """A table whose rows must have a parent (the foreign key summaries.id ->
    full_documents.id, kept at write): ``accepted`` and ``rejected`` are versioned
    tables, the second with a ``reason`` (``no key`` or ``no parent``)."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "id"):
        self.key = key
        self.accepted = VersionedTable(spark, f"{root}/accepted", schema, key)
        self.rejected = VersionedTable(spark, f"{root}/rejected", StructType([*schema.fields, StructField("reason", StringType())]), key)

    def append(self, rows: DataFrame, parent: DataFrame, writer: str, batch: int, parent_key: str | None = None) -> None:
        """Add a batch: each row goes to one of the two tables. The parent's keys
        are looked up once; a replayed batch changes neither table. The rejected
        rows are committed first, so an accepted batch is always a complete one."""
        if self.accepted.snapshot().has(writer, batch):
            return
        reason = F.when(F.col(self.key).isNull(), F.lit("no key")).when(~F.col("__known"), F.lit("no parent"))
        told = stage(flag_exists(rows, parent, "__known", self.key, parent_key).withColumn("reason", reason), "checked")
        self.rejected.append(told.where("reason is not null"), writer, batch)
        self.accepted.append(told.where("reason is null"), writer, batch)


def clear_table(spark: SparkSession, name: str) -> int | None:
    """Delete all rows, keep the schema (G6). Returns the rows removed, or
    None when the table does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    n = spark.table(name).count()
    try:
        spark.sql(f"TRUNCATE TABLE {name}")
    except Exception:  # external tables refuse TRUNCATE: switch to an empty version
        empty = spark.createDataFrame([], spark.table(name).schema)
        replace_table(spark, name, empty)
    spark.catalog.refreshTable(name)
    return n


def replace_table(spark: SparkSession, name: str, new_content: DataFrame,
                  root: str | None = None) -> str:
    """Write ``new_content`` (which may read ``name`` itself) as a new version
    and switch the table to it. Returns the new version's location.

    A plain table gets a fresh location and ``SET LOCATION``. A bucketed
    table gets a twin (``CREATE TABLE .. LIKE`` keeps the bucket spec), is
    filled with ``insertInto`` (which buckets the rows) and swapped in by
    renames, so its joins stay shuffle-free. A plain table's previous files
    are kept for readers that started before the switch (removing them is
    the caller's housekeeping); a bucketed table's previous version is
    dropped after the swap."""
    info = _describe(spark, name)
    target = spark.table(name).schema
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields]
    stamp = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    if info.get("Num Buckets") not in (None, "", "-1"):
        twin, old = f"{name}__v{stamp}", f"{name}__old{stamp}"
        spark.sql(f"CREATE TABLE {twin} LIKE {name}")
        # one task per bucket, so one file per bucket
        new_content.select(*cols).repartition(int(info["Num Buckets"]), "id").write.insertInto(twin)
        spark.sql(f"ALTER TABLE {name} RENAME TO {old.split('.')[-1]}")
        spark.sql(f"ALTER TABLE {twin} RENAME TO {name.split('.')[-1]}")
        spark.sql(f"DROP TABLE {old}")
        return _describe(spark, name)["Location"]
    if root is None:
        root = info["Location"].rsplit("/", 1)[0]
    fresh = f"{root}/{name.split('.')[-1]}__v{stamp}"
    new_content.select(*cols).write.mode("errorifexists").parquet(fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)
    return fresh


def keyed_json(df: DataFrame, key: str = "id") -> DataFrame:
    """One JSON object per row, keyed by ``key``:
    ``{"<id>": {<other columns>}}``, NULLs kept as ``null``, non-ASCII kept."""
    rest = [c for c in df.columns if c != key]
    obj = F.create_map(F.col(key), F.struct(*rest))
    return df.select(F.col(key), F.to_json(obj, {"ignoreNullFields": "false"}).alias("json"))


def dump_keyed_json(df: DataFrame, path: str, key: str = "id") -> bool:
    """Table → keyed JSON, one object per line, written in parallel.
    Nothing is written when the table is empty. A reader that wants one
    object merges the lines; merging them in one task is what the table's
    size forbids."""
    if df.isEmpty():
        return False
    keyed_json(df, key).select("json").write.mode("overwrite").text(path)
    return True


def write_documents(df: DataFrame, path: str, key: str = "id", texts: str = "texts",
                    mode: str = "append") -> None:
    """Converted documents as JSON lines: ``{"id": .., "texts": [..]}``."""
    df.select(key, texts).write.mode(mode).json(path)


def sections_store(spark: SparkSession, path: str) -> VersionedTable:
    """The sections store (A4, G9): a versioned table of (id, abstract, conclusion)."""
    return VersionedTable(spark, path, schemas.SECTIONS)


def write_sections(df: DataFrame, path: str, writer: str, batch_id: int = 0) -> int:
    """Add newly extracted sections to the sections store (G9) as batch
    ``batch_id`` of ``writer``. A batch is added once: repeated, it is neither
    computed nor written, and keeps the place in the order of commits that it got
    the first time. Returns the store's version."""
    return sections_store(df.sparkSession, path).append(df.select("id", "abstract", "conclusion"), writer, batch_id)


def read_batch(spark: SparkSession, path: str, writer: str, batch_id: int = 0) -> DataFrame:
    """The sections that one batch of one writer added (until it is compacted)."""
    return sections_store(spark, path).read(keep=lambda p: (p.writer, p.batch) == (writer, batch_id))


def compact_sections(spark: SparkSession, path: str, keep_versions: int = 2) -> int:
    """Make the store's parts one, with one row per id: the one committed last.
    Returns the store's version; older versions but ``keep_versions`` are removed."""
    store = sections_store(spark, path)
    version = store.compact(newest_rows)
    store.vacuum(keep_versions)
    return version
