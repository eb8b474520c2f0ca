"""Incremental section extraction as a file stream.

New parsed-document files dropped into a folder are extracted once. Two kinds of
state keep it so, both in the checkpoint: the file source's log (which files were
seen) and a keyed state store (which ids were): ``dropDuplicates`` on the id
passes an id's first row and drops all later ones, so a document that is sent
again in another file isn't stored twice. No micro-batch looks at the sections
store, whatever its size.

Each micro-batch is one commit to the store (``sinks.tables.write_sections``). A
batch that is replayed after a failure finds itself committed and changes
nothing; one that failed before its commit starts from the state of the batch
before, so it admits the same ids again. Streams with their own checkpoint are
writers of their own; an id that two of them extract has two rows in the store,
of which readers take the one committed last.

The sections store is append-only. The document table's abstract and
conclusion are merged from it on read (``documents_with_sections``) or
compacted with ``partial_update`` + ``replace_table``; rewriting the whole
document table per micro-batch would not scale.

There is no event time in this data, so no watermark: the state holds one id per
stored document. With ``spark.sql.streaming.stateStore.providerClass`` set to
Spark's RocksDB provider (``session.CLUSTER_CONF``) it lives on the executors'
disks, not in their heaps. It is partitioned by ``spark.sql.shuffle.partitions``
as of the first start. When one micro-batch holds several rows of a new id, one of
them is admitted; which one is not defined.

Scale: ``max_files_per_trigger`` bounds a micro-batch when the caller sets it. A
batch is computed once, by the write of its commit.

Two source layouts: ``"parsed"`` (one JSON document per file, id = file
stem) and ``"converted"`` (JSON lines ``{"id", "texts"}`` as
``sinks.tables.write_documents`` writes them).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.sections import assemble_content, parsed_document_content, with_sections
from quire.operators import filters, upserts
from quire.sinks.tables import sections_store, write_sections
from quire.sources.files import file_stem


def parsed_document_stream(spark: SparkSession, in_dir: str, glob: str = "*.json",
                           exclude: list[str] | None = None,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(in_dir).select(F.col("_metadata.file_name").alias("file_name"),
                                     F.col("value").alias("raw"))
    if exclude:
        raw = raw.filter(~F.col("file_name").isin(exclude))
    return raw.select(file_stem("file_name").alias("id"),
                      parsed_document_content("raw").alias("content"))


def converted_document_stream(spark: SparkSession, in_dir: str,
                              max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema("id string, texts array<map<string,string>>")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(in_dir).select("id", assemble_content("texts").alias("content"))


def extract_stream(spark: SparkSession, in_dir: str, sections_dir: str, checkpoint: str,
                   glob: str = "*.json", exclude: list[str] | None = None,
                   available_now: bool = True,
                   max_files_per_trigger: int | None = None,
                   source: str = "parsed", writer: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it handles what is there
    and stops (``query.awaitTermination()``). ``writer`` names this stream in
    the store; by default the name follows from its checkpoint folder."""
    writer = writer or "stream-" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    if source == "converted":
        docs = converted_document_stream(spark, in_dir, max_files_per_trigger)
    else:
        docs = parsed_document_stream(spark, in_dir, glob, exclude, max_files_per_trigger)
    found = filters.with_any_section(
        with_sections(docs, status=None).select("id", "abstract", "conclusion"))

    admitted = found.dropDuplicates(["id"])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if sections_store(spark, sections_dir).snapshot().has(writer, batch_id):
            # replayed: nothing to store, but the keyed state commits with the batch's run
            batch.write.format("noop").mode("overwrite").save()
        else:
            write_sections(batch, sections_dir, writer, batch_id)

    out = (admitted.writeStream.foreachBatch(write_batch)
           .option("checkpointLocation", checkpoint))
    out = out.trigger(availableNow=True) if available_now else out.trigger(
        processingTime="30 seconds")
    return out.start()


def documents_with_sections(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """The document table with the stored sections merged in (non-NULL
    section values win), as the extraction step's UPDATE would leave it."""
    return upserts.partial_update(docs, sections.select("id", "abstract", "conclusion"),
                                  ["abstract", "conclusion"], "id")
