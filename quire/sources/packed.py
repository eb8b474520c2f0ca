"""Small files, one document each: written by tasks, and packed into containers
(A2, A3, G10).

A folder of millions of small files is slow to list and to open, again in every
run. ``PackedFiles`` keeps their bytes in a versioned table of Parquet containers,
sorted by id: the row groups' statistics are the index, so a read of some ids opens
few row groups, and a read of all of them opens large files only. ``refresh`` lists
the folder, without any bytes, and packs the files that are new or have another
length or time; it commits once, so a run that is killed adds nothing. (Spark's
file scans pass over empty files, here as in ``files.list_files``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.sections import parsed_document_content
from quire.operators import upserts
from quire.operators.answers import shared_fs
from quire.operators.layout import stage
from quire.sinks.versions import VersionedTable
from quire.sources.files import file_stem, listed_files, with_bytes

PACKED = T.StructType([T.StructField("id", T.StringType()), T.StructField("path", T.StringType()),
                       T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
                       T.StructField("content", T.BinaryType())])


def write_files(df: DataFrame, path: str, name: str, content: str, folders: int = 0) -> int:
    """One file per row, named by ``name``, with the bytes (or UTF-8 text) of
    ``content``; the tasks write them. A file is moved into place when it is
    complete, and a task that is tried again writes the same files. Returns the
    number of files. With ``folders``, a file goes to one of so many subfolders
    ``part=<number>`` by its name, which ``files.listed_files`` lists by several
    tasks. A NULL content is an empty file; a NULL name fails the job."""
    def run(batches):
        import uuid
        import zlib

        import pyarrow as pa

        fs, top = shared_fs(path)
        fs.create_dir(top, recursive=True)
        made, n = {top}, 0
        for batch in batches:
            for file_name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file_name is None or "/" in file_name:
                    raise ValueError(f"not a file name: {file_name!r}")
                root = f"{top}/part={zlib.crc32(file_name.encode()) % folders}" if folders else top
                if root not in made:
                    fs.create_dir(root, recursive=True)
                    made.add(root)
                aside = f"{root}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(aside) as out:
                    out.write(body or b"")
                fs.move(aside, f"{root}/{file_name}")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    rows = df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


class PackedFiles:
    """The packed files of one folder, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.table = VersionedTable(spark, root, PACKED)
        self.table.create(buckets)

    def refresh(self, folder: str, glob: str = "*", exclude: list[str] | None = None) -> int:
        """Pack what is new or changed in ``folder``; files that are gone stay
        packed. Returns the table's version."""
        listed = stage(listed_files(self.spark, folder, glob, exclude).select(
            file_stem("name").alias("id"), "path", "length", "modified"), "listed")
        known = self.table.read().select("id", "length", "modified")
        todo = stage(listed.join(known, ["id", "length", "modified"], "left_anti"), "to-pack")
        if todo.isEmpty():
            return self.table.snapshot().version
        fresh = with_bytes(todo)
        fresh = fresh.withColumn("order", F.col("modified"))
        return self.table.merge(fresh, lambda old, new: upserts.upsert_replace(old, new, "id", seq="order"))

    def read(self, ids: list[str] | None = None, version: int | None = None) -> DataFrame:
        """(id, path, length, content); with ``ids``, only theirs, which the scan
        skips to by its statistics."""
        rows = self.table.read(version).select("id", "path", "length", "content")
        return rows if ids is None else rows.where(F.col("id").isin(ids))

    def read_parsed(self) -> DataFrame:
        """(id, content) of parsed-document JSON files, as
        ``files.read_parsed_documents`` gives them."""
        return self.table.read().select("id", parsed_document_content(F.decode("content", "UTF-8")).alias("content"))
