"""Row filters and top-N over the document table.

All of these are declarative, so Catalyst pushes the simple ones
(``IS NULL``, ``IS NOT NULL``, date bounds) into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.prompts import summarisable as _summarisable
from quire.functions.search import date_range_predicate, has_any_author, keyword_predicate
from quire.operators.layout import fence


def search_papers(df: DataFrame, keywords: list[str], cols=("title", "content")) -> DataFrame:
    """Rows where any keyword phrase occurs, case-insensitively, in any of
    ``cols`` (B1). ``keywords`` are expressions such as
    ``'"world model" OR "world models"'``; the search is their OR."""
    return df.filter(keyword_predicate(list(cols), keywords))


def newest(df: DataFrame, n: int, by: str = "submitted_at", tie: str = "id") -> DataFrame:
    """The ``n`` newest rows, newest first, ties by ``tie`` (B2).
    Plans as TakeOrderedAndProject: each task keeps its own top ``n``, so
    only ``n`` rows per task reach the final merge."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie).asc()).limit(n)


def in_date_range(df: DataFrame, col: str, date_from: str, date_to: str, as_of) -> DataFrame:
    """Rows whose ``col`` lies in a symbolic range such as
    ``lastWeek``..``today`` relative to ``as_of`` (B3)."""
    return df.filter(date_range_predicate(col, date_from, date_to, as_of))


def by_authors(df: DataFrame, names: list[str], col: str = "author_names") -> DataFrame:
    """Rows with at least one of ``names`` among the authors."""
    return df.filter(has_any_author(col, names))


def with_url(df: DataFrame, col: str = "pdf_url") -> DataFrame:
    """Rows that have a PDF link."""
    return df.filter(F.col(col).isNotNull())


def pending(df: DataFrame, col: str = "selected") -> DataFrame:
    """Rows not judged yet."""
    return df.filter(F.col(col).isNull())


def summarisable(df: DataFrame, abstract: str = "abstract",
                 conclusion: str = "conclusion") -> DataFrame:
    """Rows with a non-blank abstract or conclusion (B7). The sections are
    usually computed columns, hence the fence (see ``layout.fence``)."""
    return fence(df, [abstract, conclusion]).filter(_summarisable(abstract, conclusion))


def with_any_section(df: DataFrame, abstract: str = "abstract",
                     conclusion: str = "conclusion") -> DataFrame:
    """Rows where extraction found a section (the ones that are recorded)."""
    return (fence(df, [abstract, conclusion])
            .filter(F.col(abstract).isNotNull() | F.col(conclusion).isNotNull()))
