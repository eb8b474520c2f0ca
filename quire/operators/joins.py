"""Joins and existence tests.

Semi and anti joins take the other side's keys as they are: both sides are
then plain shuffles, and adaptive execution splits a hot key's partition (an
aggregate between shuffle and join would forbid that). A flag join must not
repeat rows, so its distinct keys are written first (``layout.stage``): again
a plain shuffle, or a broadcast when the written keys are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.layout import stage


def _keys(df: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    k = F.col(other_key or key).alias(key)
    return df.select(k).filter(F.col(key).isNotNull())


def summaries_report(docs: DataFrame, summaries: DataFrame, key: str = "id",
                     title: str = "title", summary: str = "summary") -> DataFrame:
    """(id, title, summary) for papers with a summary, ordered by id.
    The join strategy (broadcast or sort-merge) is left to AQE, which sees
    the real size of the filtered summaries."""
    s = summaries.select(key, summary).filter(F.col(summary).isNotNull())
    return (docs.select(key, title).join(s, key, "inner")
                .select(key, title, summary).orderBy(key))


def unprocessed(todo: DataFrame, done: DataFrame, key: str = "id",
                done_key: str | None = None) -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``."""
    return todo.join(_keys(done, key, done_key), key, "left_anti")


def missing_outputs(inputs: DataFrame, outputs: DataFrame, key: str = "id",
                    output_key: str | None = None) -> DataFrame:
    """Inputs whose output does not exist yet."""
    return inputs.join(_keys(outputs, key, output_key), key, "left_anti")


def known_only(new: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``new`` whose key exists in ``table`` (D3, the updatable set)."""
    return new.join(_keys(table, key), key, "left_semi")


def unknown_only(new: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``new`` whose key is not in ``table`` (D3, the failed set)."""
    return new.join(_keys(table, key), key, "left_anti")


def flag_exists(df: DataFrame, other: DataFrame, flag: str, key: str = "id",
                other_key: str | None = None) -> DataFrame:
    """``df`` plus a boolean ``flag``: is the key present in ``other``.
    A left join against distinct keys, so no row is repeated."""
    marks = stage(_keys(other, key, other_key).distinct(), "flags").withColumn(flag, F.lit(True))
    return (df.join(marks, key, "left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def match_known(new: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """``new`` tagged with ``known``: only known ids may be updated, the rest
    count as failed (D3)."""
    return flag_exists(new, table, "known", key)


def with_parsed_file(docs: DataFrame, files: DataFrame, key: str = "id",
                     file_key: str = "stem") -> DataFrame:
    """Table rows tagged with ``has_file``: is there a parsed file whose
    stem is the id (D5). A row without one counts as failed."""
    return flag_exists(docs, files, "has_file", key, file_key)
