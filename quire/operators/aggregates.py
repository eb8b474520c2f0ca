"""Counts and run statistics.

All are hash aggregates with map-side partial aggregation, so a hot group
costs one partial row per task, never a whole group in one task. Counters
that combine several inputs tag and union them and run one aggregate: no
cross join of one-row results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labels of the selection states.
SELECTION_LABELS = {"yes": "selected", "no": "rejected"}
PENDING_LABEL = "pending"


def selection_stats(docs: DataFrame, col: str = "selected") -> DataFrame:
    """Papers per selection state; NULL is its own group.
    Columns: (selected, label, n)."""
    label = F.when(F.col(col) == "yes", F.lit(SELECTION_LABELS["yes"])) \
             .when(F.col(col) == "no", F.lit(SELECTION_LABELS["no"])) \
             .otherwise(F.lit(PENDING_LABEL))
    return (docs.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
                .select(F.col(col).alias("selected"), label.alias("label"), "n"))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Rows in a table, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by_status(df: DataFrame, statuses: list[str], col: str = "status",
                    total: str = "total") -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.count_if(F.col(col) == s).alias(s) for s in statuses]
    return df.agg(*aggs)


def conversion_counters(converted: DataFrame, col: str = "status") -> DataFrame:
    """total / ok / failed / skipped over a conversion run (E4). Skips are
    counted (the source pipeline always reported 0)."""
    return count_by_status(converted, ["ok", "failed", "skipped"], col)


def observed_extraction(spark, total: int, files: int, stored: int, ok: int, skipped: int) -> DataFrame:
    """The row of ``extraction_counters`` from counts that ``DataFrame.observe``
    took while the pass wrote its tables: a document that is neither ok nor
    skipped has failed."""
    return spark.createDataFrame([(total, files, stored, ok, skipped, total - ok - skipped)],
                                 "total_documents long, json_files long, previously_processed long, ok long, "
                                 "skipped long, failed long")


def extraction_counters(outcomes: DataFrame, files: DataFrame, done: DataFrame,
                        outcome: str = "outcome") -> DataFrame:
    """Run summary of an extraction pass (E2 with E3):
    total documents, JSON files, previously processed, ok, skipped, failed.

    ``outcomes`` has one row per document with ``outcome`` in
    ok / skipped / failed; ``files`` and ``done`` are only counted.
    """
    kind = "__kind"
    tagged = reduce(lambda a, b: a.unionByName(b), [
        outcomes.select(F.lit("doc").alias(kind), F.col(outcome).alias(outcome)),
        files.select(F.lit("file").alias(kind), F.lit(None).cast("string").alias(outcome)),
        done.select(F.lit("done").alias(kind), F.lit(None).cast("string").alias(outcome)),
    ])
    k, o = F.col(kind), F.col(outcome)
    return tagged.agg(
        F.count_if(k == "doc").alias("total_documents"),
        F.count_if(k == "file").alias("json_files"),
        F.count_if(k == "done").alias("previously_processed"),
        F.count_if(o == "ok").alias("ok"),
        F.count_if(o == "skipped").alias("skipped"),
        F.count_if(o == "failed").alias("failed"),
    )
