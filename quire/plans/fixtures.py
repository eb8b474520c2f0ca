"""Test inputs derived from the driver's tables.

``papers`` turns each ``documents`` row into a paper: a text-block list
with section headings in several spellings (so the extraction rules are
exercised), an id with a version, authors, a PDF link, an Atom metadata
entry, and, from ``labels``, a selection state and a raw model answer.
The rules are the ones written down in FIXTURES.md; the DuckDB side of
every oracle uses the same rules.

The ``labels`` join is only added when a query needs ``selected`` or
``model_response`` (``with_labels=True``): it is a shuffle join that
column pruning cannot remove, so queries that do not need it skip it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import WS
from quire.operators.layout import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_if_asked(df: DataFrame, fence_cols: list[str] | None = None) -> DataFrame:
    """``spread`` to the number in the session setting ``spark.quire.inputPartitions``
    (the bench sets it: its tables are one row group each); unset, the plain scan."""
    n = df.sparkSession.conf.get("spark.quire.inputPartitions", None)
    return spread(df, int(n), fence_cols) if n else df


#: At least six digits; lpad to a fixed length would cut longer ids, so that papers share one.
_PAPER_ID = """concat('2401.', lpad(cast(doc_id as string), greatest(6, length(cast(doc_id as string))), '0'),
  'v', doc_id % 3 + 1)"""

_BLOCKS = """concat(
  array(concat('Paper ', doc_id)),
  case av when 0 then array('Abstract', ls[0]) when 1 then array('ABSTRACT', ls[0])
          when 2 then array(concat('Abstract — ', ls[0])) when 3 then array(concat('Abstract: ', ls[0]))
          when 4 then array(ls[0]) else array('Abstract', substr(ls[0], 1, 20)) end,
  array('1 Introduction'), ls,
  case cv when 0 then array('5. Conclusions', ls[size(ls)-1]) when 1 then array('CONCLUSION', ls[size(ls)-1])
          when 2 then array('Conclusion and Limitations', ls[size(ls)-1]) when 3 then array('6 Discussion', ls[size(ls)-1])
          when 4 then array('Concluding Remarks', ls[size(ls)-1]) else cast(array() as array<string>) end,
  array('References', '[1] cited work'))"""

_ATOM = """case when doc_id % 5 = 0 then '<entry></entry>' else concat(
  '<entry><author><arxiv:affiliation> ', source, ' </arxiv:affiliation></author><author><affiliation>', source, '</affiliation></author>',
  case doc_id % 3 when 0 then concat('<arxiv:comment>Lab of ', lang, '</arxiv:comment>')
                  when 1 then '<arxiv:comment>12 pages</arxiv:comment>' else '' end, '</entry>') end"""

_MODEL_RESPONSE = """case doc_id % 6
  when 0 then concat('{"is_prestigious": ', case when quality = 1 then 'true' else 'false' end, ', "reason": "q"}')
  when 1 then concat('{"is_prestigious": "', case when quality = 1 then 'yes' else 'no' end, '", "reason": "q"}')
  when 2 then '{"is_prestigious": true}'
  when 3 then 'I think so'
  when 4 then concat('{"is_prestigious": ', case when quality = 1 then '1' else '0' end, ', "reason": ""}')
  else '{"is_prestigious": true, "reason": 5}' end"""


def papers(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = spread_if_asked(docs, ["text"])
    d = docs.selectExpr(
        "doc_id", "lang", "source", "split(text, '\\n') ls",
        "cast(doc_id % 6 as int) av", "cast((doc_id div 6) % 6 as int) cv")
    b = d.withColumn("blocks", F.expr(_BLOCKS))
    strip_re = f"(?U)^{WS}+|{WS}+$"
    out = b.select(
        "doc_id",
        F.expr(_PAPER_ID).alias("paper_id"),
        F.expr("substr(ls[0], 1, 60)").alias("title"),
        F.expr("array(concat('Author ', doc_id % 7), concat('Author ', doc_id % 11))")
         .alias("author_names"),
        F.expr("case when doc_id % 10 <> 0 then concat('https://example.org/pdf/', doc_id) end")
         .alias("pdf_url"),
        F.expr("case doc_id % 4 when 0 then null when 1 then '' else source end").alias("affiliation"),
        "blocks",
        F.concat(F.array_join(F.transform("blocks", lambda x: F.regexp_replace(x, strip_re, "")),
                              "\n\n"), F.lit("\n\n")).alias("content"),
        F.expr(_ATOM).alias("atom_xml"),
        # Submission time for date ranges and "newest": one hour per doc_id.
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, doc_id, 0, 0)")
         .alias("submitted_at"),
    )
    if not with_labels:
        return out
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (out.join(labels, "doc_id", "left")
               .withColumn("selected", F.expr("case quality when 1 then 'yes' when 0 then 'no' end"))
               .withColumn("model_response", F.expr(_MODEL_RESPONSE))
               .drop("quality"))


def paper_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text-free columns of ``papers`` (doc_id, paper_id, author_names,
    pdf_url), all derived from ``doc_id``: a one-column scan, no spread."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.select(
        "doc_id",
        F.expr(_PAPER_ID).alias("paper_id"),
        F.expr("array(concat('Author ', doc_id % 7), concat('Author ', doc_id % 11))")
         .alias("author_names"),
        F.expr("case when doc_id % 10 <> 0 then concat('https://example.org/pdf/', doc_id) end")
         .alias("pdf_url"))


def papers_table(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    """``papers`` shaped as the document table: (id, title, authors,
    pdf_url, affiliation[, selected]) with no sections filled yet."""
    p = papers(spark, sf_dir, with_labels)
    cols = [F.col("doc_id"), F.col("paper_id").alias("id"), "title",
            F.array_join("author_names", ", ").alias("authors"), "pdf_url", "affiliation"]
    if with_labels:
        cols.append("selected")
    return p.select(*cols)
