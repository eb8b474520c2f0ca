"""A named search from the query config, applied to a paper table.

The config shape is the source pipeline's: ``keywords`` (expressions of
quoted phrases joined by OR), optional ``authors``, a symbolic
``date_range`` and ``max_results``. Keywords select; authors and the date
range, when given, narrow further; the newest ``max_results`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quire.operators import filters


def run_search(df: DataFrame, config: dict, as_of, text_cols=("title", "content"),
               authors_col: str = "author_names", date_col: str = "submitted_at",
               id_col: str = "id") -> DataFrame:
    # cheap tests first: a text is lower-cased only for rows that pass the others
    out = df
    if config.get("date_range"):
        rng = config["date_range"]
        out = filters.in_date_range(out, date_col, rng["from"], rng["to"], as_of)
    if config.get("authors"):
        out = filters.by_authors(out, config["authors"], authors_col)
    out = filters.search_papers(out, config["keywords"], text_cols)
    if config.get("max_results") is not None:
        out = filters.newest(out, int(config["max_results"]), by=date_col, tie=id_col)
    return out
