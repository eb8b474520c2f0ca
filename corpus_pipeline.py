"""A training corpus from ``documents`` in five stages, each one operator of
``quire.llm``: language ID, quality classifier, near-duplicate join, mixing of
sources, SentencePiece encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. Two stages number the rows, so that rows which repeat a doc_id stay
apart (``_numbered``): by file and place in it, which no later scan changes, so the
texts aren't written again.

In every stage an empty table gives no rows, columns beyond those of documents
stay as they are whatever their names, and a text of any length is taken whole.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import jaccard_join, language_crf, mixing, pieces, quality_classifier
from quire.llm.common import narrow, remainder, stage, table
from quire.session import scratch_path

#: Not SQL: three of the stages learn models. Each stage is tested by itself.
ORACLE_SQL = None
#: At most so many file names (some 150 bytes each) are sorted in one task and broadcast.
MOST_FILES = 200_000
#: A file has fewer rows than this.
ROWS = 1 << 36


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a row number that every later scan repeats, however it is
    split: the file's number and the row's place in the file. Rows that aren't read
    straight from Parquet files, or are from over ``MOST_FILES`` of them, are written
    once with their numbers instead.
    """
    files = _files(docs)
    if files is None:
        return stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    path, place = _fresh(docs, "file_path"), _fresh(docs, "file_place")
    about = docs.metadataColumn("_metadata")
    return (docs.withColumns({path: about["file_path"], place: about["row_index"]})
            .join(F.broadcast(files), F.col(path) == F.col("__path"))
            .withColumn(row, F.col("__file").cast("long") * ROWS + F.col(place)).select(*docs.columns, row))


def _files(docs: DataFrame) -> DataFrame | None:
    """(__path, __file), a written table with a number for each of the files that
    ``docs`` is read from, or None where ``_numbered`` can't go by files."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return None         # an explode would repeat a row's file and place
    try:
        about = docs.metadataColumn("_metadata")
        paths = docs.groupBy(about["file_path"].alias("__path")).agg(
            F.count("*").alias("rows"), F.max(about["row_index"]).alias("last"))
    except AnalysisException:               # not Parquet
        return None
    files = stage(paths.select("__path", (F.col("rows") == F.col("last") + 1).alias("once")), "files")
    n, once = files.agg(F.count("*"), F.coalesce(F.min("once"), F.lit(True))).first()
    if n > MOST_FILES or not once:          # a folder named twice in one read has its rows twice
        return None
    # by name: a rerun that writes the same files under another job's id numbers them alike
    return stage(files.select("__path", F.row_number().over(Window.orderBy("__path")).alias("__file")), "files")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts whose words are of learned languages, one or several: the
    words' best posteriors are at least 0.5 on average, so a text that switches
    between learned languages stays, whatever its largest share.

    Null and empty texts, and texts without a letter, go (`und`); rows that repeat
    an id or a text are decided alike, by their text alone; a null lang is not
    learned from. Without a labelled text there is no language, and all go.
    """
    model = language_crf.fit(docs.where(remainder(F.col("doc_id"), 3) != 1))
    lang, score, sure = (_fresh(docs, f"lang_{name}") for name in ("pred", "score", "confidence"))
    told = language_crf.predict(docs, model, as_columns=(lang, score, sure))
    return told.where((F.col(lang) != "und") & (F.col(sure) >= 0.5)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts whose probability of label 1 is at least 0.3.

    Null and empty texts get the model's probability of a text without features;
    rows that repeat an id or a text are decided alike, by their text alone.
    Without labels of both kinds every text gets one probability.
    """
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    score = _fresh(docs, "quality_score")
    told = quality_classifier.score(docs, quality_classifier.fit(docs, labels), as_column=score)
    return told.where(F.col(score) >= 0.3).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked texts: the one with the smallest
    doc_id (a null id comes last; of rows that repeat it, the first in the stored
    order).

    Texts without words are linked with nothing, so all of them stay. Rows that
    repeat an id are rows of their own, and stay unless their texts are linked.
    """
    row = _fresh(docs, "row_number")
    numbered = _numbered(docs, row)
    linked = stage(jaccard_join.join(numbered, id_col=row).select(
        F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")), "groups")
    # the groups of two rows and more, with all their rows
    large = narrow(linked.where("__row <> __group").select(F.col("__group").alias("__of")).distinct())
    members = linked.join(large, F.col("__group") == F.col("__of")).select("__row", "__group")
    ids = numbered.select(F.col(row).alias("__row"), F.col("doc_id").alias("__id"))
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    members = stage(ids.join(members, "__row"), "members")
    keepers = members.groupBy("__group").agg(F.min(order)["row"].alias("__keep"))
    dropped = (members.join(keepers, "__group").where("__row <> __keep").select(F.col("__row").alias(row)))
    return numbered.join(narrow(dropped), row, "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes its words: round(taken / size) times.

    Texts without words have nothing to take and go, as do rows of which the mix
    takes less than half; a null source is a source of its own; rows that repeat
    an id are rows of their own.
    """
    row, copies = _fresh(docs, "row_number"), _fresh(docs, "copies")
    numbered = _numbered(docs, row)
    times = (mixing.mix(numbered, id_col=row).where("size > 0")
             .select(F.col("doc_id").alias(row), F.round(F.col("taken") / F.col("size")).cast("int").alias(copies))
             .where(F.col(copies) > 0))
    return (numbered.join(narrow(times), row)
            .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids) of every row; a null or empty text has
    no pieces, and rows that repeat are encoded as they stand."""
    import public_tokenizers

    out = pieces.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "lang", "source", "n_pieces", "ids")


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates),
          ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/pipeline-{name}-{uuid.uuid4().hex}")
        out = step(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
