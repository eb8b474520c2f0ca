"""Scans: document tables, parsed-document JSON files, binary files and the
sections store (A1-A4)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import schemas
from quire.functions.sections import assemble_content, parsed_document_content
from quire.operators.answers import shared_fs
from quire.operators.joins import known_only
from quire.operators.layout import lean
from quire.sinks.versions import SEQ, VersionedTable, newest_rows

STEM = r"^(.*)\.[^.]+$"


def file_stem(name_col) -> F.Column:
    """File name without its last extension."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.regexp_extract(c, STEM, 1)


def read_papers(spark: SparkSession, path: str, cols: list[str] | None = None,
                schema=schemas.FULL_DOCUMENTS) -> DataFrame:
    """The document table with an explicit schema; ``cols`` selects a
    subset, which Catalyst turns into a pruned parquet ``ReadSchema`` (A1)."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*cols) if cols else df


#: Bytes of files that a task holds at once; a longer file alone, whole.
READ_BYTES = 8 << 20
#: Characters that a file's URI has quoted, % first.
_QUOTED = "%" + "".join(map(chr, [*range(1, 33), 127])) + '"#<>?[\\]^`{|}'
_LISTED = "name string, path string, length long, modified timestamp"


def _folders(spark: SparkSession, path: str) -> list[str] | None:
    """A folder and its ``key=value`` subfolders (as Spark's partition discovery
    takes them) for tasks to list, or None where only Spark can read: globs, odd
    names, files beside subfolders, and file systems that the tasks' Python doesn't know."""
    if not isinstance(path, str):
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return None
    root = fs.makeQualified(at).toString()
    try:
        shared_fs(root)
    except Exception:       # pyarrow has no such file system, or not its library
        return None
    top = spark.createDataFrame([(root,)], "folder string")
    folders = [root] + [r[0] for r in top.mapInArrow(lean(_subfolders), "folder string").collect()]
    return folders if all(re.fullmatch(r"[\w:/.=@,+-]+", f, re.ASCII) for f in folders) else None


def _listed(folder: str):
    from pyarrow import fs as pafs

    fs, root = shared_fs(folder)
    return fs.get_file_info(pafs.FileSelector(root))


def _subfolders(batches):
    import pyarrow as pa

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = _listed(folder)
            names = [f.base_name for f in found if "=" in f.base_name and not f.is_file]
            if names and any(f.is_file for f in found):
                names = ["*"]           # files beside subfolders: Spark's rules decide
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in names], pa.string())], ["folder"])


def listed_files(spark: SparkSession, path: str, glob: str = "*", exclude: list[str] | None = None) -> DataFrame:
    """(name, path, length, modified) of a folder's files, without their bytes.

    Tasks list the folder and its ``key=value`` subfolders: Spark's own scan holds
    every file's status at the driver, and, as it counts 4 MB for opening a file,
    makes a task of every 32. Its rules hold here too: hidden and empty files are
    passed over. A path that the tasks can't list is left to that scan."""
    folders = _folders(spark, path)
    if folders is None:
        df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        df = df.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length",
                       F.col("modificationTime").alias("modified"))
        return df.filter(~F.col("name").isin(exclude)) if exclude else df

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            todo = batch.column(0).to_pylist()
            while todo:
                folder = todo.pop()
                found = _listed(folder)
                if folder != folders[0]:
                    todo += [f"{folder}/{f.base_name}" for f in found if "=" in f.base_name and not f.is_file]
                for i in range(0, len(found), 10_000):
                    some = [f for f in found[i:i + 10_000] if f.is_file and f.size]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f.base_name for f in some], pa.string()),
                         pa.array([f"{folder}/{f.base_name}" for f in some], pa.string()),
                         pa.array([f.size for f in some], pa.int64()),
                         pa.array([f.mtime_ns // 1_000_000 * 1000 for f in some], pa.timestamp("us", tz="UTC"))],
                        ["name", "path", "length", "modified"])

    names = spark.createDataFrame([(f,) for f in folders], "folder string")
    tasks = min(len(folders), 4 * spark.sparkContext.defaultParallelism)
    df = names.repartition(tasks).mapInArrow(lean(run), _LISTED)
    regex = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    hidden = F.col("name").rlike(r"^(_[^=]*$|\.)|\._COPYING_$")
    df = df.filter(F.col("name").rlike(rf"(?s)\A(?:{regex})\z") & ~hidden)
    return df.filter(~F.col("name").isin(exclude)) if exclude else df


def with_bytes(listed: DataFrame) -> DataFrame:
    """``listed`` (a row per file, by ``path``) with ``content``, its bytes. The files
    are dealt evenly to a few tasks a core, each of which holds some at a time."""
    spark = listed.sparkSession
    at = listed.columns.index("path")

    def run(batches):
        import pyarrow as pa

        opened = {}

        def rows(batch, bodies):
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.binary())],
                                              [*batch.schema.names, "content"])
        for batch in batches:
            first, held, bodies = 0, 0, []
            for i, path in enumerate(batch.column(at).to_pylist()):
                folder, _, name = path.rpartition("/")
                if folder not in opened:
                    opened[folder] = shared_fs(folder)
                fs, root = opened[folder]
                with fs.open_input_stream(f"{root}/{name}") as f:
                    body = f.read()
                if bodies and held + len(body) > READ_BYTES:
                    yield rows(batch.slice(first, len(bodies)), bodies)
                    first, held, bodies = i, 0, []
                held += len(body)
                bodies.append(body)
            if bodies:
                yield rows(batch.slice(first, len(bodies)), bodies)

    ddl = T.StructType([*listed.schema.fields, T.StructField("content", T.BinaryType())])
    return listed.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(lean(run), ddl)


def read_parsed_documents(spark: SparkSession, path: str, glob: str = "*.json",
                          exclude: list[str] | None = None) -> DataFrame:
    """One parsed-document JSON file per paper (A2). Columns: ``id`` (the
    file stem), ``path``, ``raw`` (whole file text) and ``content`` (the
    text blocks joined, see ``parsed_document_content``). ``exclude`` drops
    file names such as the sections store kept in the same folder."""
    if _folders(spark, path) is None:
        df = (spark.read.format("text").option("wholetext", True)
                   .option("pathGlobFilter", glob).load(path)
                   .select(F.col("_metadata.file_name").alias("name"),
                           F.col("_metadata.file_path").alias("path"),
                           F.col("value").alias("raw")))
    else:
        uri = F.col("path")             # as Spark's metadata has it
        for c in _QUOTED:
            uri = F.replace(uri, F.lit(c), F.lit(f"%{ord(c):02X}"))
        df = with_bytes(listed_files(spark, path, glob).select("path")).select(
            F.element_at(F.split(uri, "/"), -1).alias("name"), uri.alias("path"), F.col("content").cast("string").alias("raw"))
    if exclude:
        df = df.filter(~F.col("name").isin(exclude))
    return df.select(file_stem("name").alias("id"), "path", "raw", parsed_document_content("raw").alias("content"))


def read_converted_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents as ``write_documents`` stores them (JSON lines
    ``{"id": .., "texts": [{"text": ..}, ..]}``, many per file, read in
    parallel): (id, content) with the blocks assembled as for A2."""
    df = spark.read.schema("id string, texts array<map<string,string>>").json(path)
    return df.select("id", assemble_content("texts").alias("content"))


def list_files(spark: SparkSession, path: str, glob: str = "*",
               exclude: list[str] | None = None) -> DataFrame:
    """File listing (id = stem, path, length) without reading any content."""
    return listed_files(spark, path, glob, exclude).select(file_stem("name").alias("id"), "path", "length")


def read_binary_documents(spark: SparkSession, path: str, glob: str = "*.pdf",
                          only: DataFrame | None = None) -> DataFrame:
    """Binary files (A3): id (stem), path, length, content bytes; with ``only``
    (id), these ids' files, before any byte is read."""
    if _folders(spark, path) is None:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
                   .select(file_stem(F.element_at(F.split("path", "/"), -1)).alias("id"),
                           "path", "length", "content"))
        return df if only is None else known_only(df, only)
    listed = list_files(spark, path, glob)
    return with_bytes(listed if only is None else known_only(listed, only))


def read_section_rows(spark: SparkSession, path: str,
                      exclude: tuple[str, int] | None = None, version: int | None = None) -> DataFrame:
    """All rows of the sections store (id, abstract, conclusion and ``SEQ``, the
    commit that added the row); empty when nothing has been stored yet.
    ``exclude`` leaves out one (writer, batch) by its parts, ``version`` reads an
    earlier version."""
    store = VersionedTable(spark, path, schemas.SECTIONS)
    return store.read(version, with_seq=True, keep=lambda p: exclude is None or (p.writer, p.batch) != exclude)


def read_sections(spark: SparkSession, path: str,
                  exclude: tuple[str, int] | None = None, version: int | None = None) -> DataFrame:
    """Previously extracted sections (A4): (id, abstract, conclusion), one
    current row per id: the one committed last."""
    return newest_rows(read_section_rows(spark, path, exclude, version)).drop(SEQ)


def read_sections_json(spark: SparkSession, path: str) -> DataFrame:
    """Sections stored as JSON keyed by id: each line an object
    ``{"<id>": {"abstract": .., "conclusion": ..}, ...}`` (as ``keyed_json``
    writes). Lines are read in parallel; no file is read whole."""
    ddl = "map<string, struct<abstract: string, conclusion: string>>"
    raw = spark.read.text(path)
    return (raw.select(F.explode(F.from_json("value", ddl)).alias("id", "s"))
               .select("id", "s.abstract", "s.conclusion"))
