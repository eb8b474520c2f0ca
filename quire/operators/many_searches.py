"""All named searches of a config in one scan (B1 with B2).

The phrases of all searches make one Aho-Corasick automaton, so a text is read
once whatever their number. Author and date tests are Columns, evaluated before a
text is looked at. Each task keeps a bounded list of the newest rows per search
and returns no more than that; the lists of all tasks are merged in two steps, so
no task sees those of all others at once.
"""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.search import date_range_predicate, expression_predicate, has_any_author

#: First merge step: so many groups of tasks.
GROUPS = 64


class Test:
    """A test of the set of (field, phrase) hits of a row, built by operators."""

    def __init__(self, holds):
        self.holds = holds

    def __or__(self, other):
        return Test(lambda hits: self.holds(hits) or other.holds(hits))

    def __and__(self, other):
        return Test(lambda hits: self.holds(hits) and other.holds(hits))

    def __invert__(self):
        return Test(lambda hits: not self.holds(hits))


def compile_searches(searches: dict[str, dict], n_fields: int) -> tuple[list[str], list]:
    """(phrases, one test per search); hits are pairs of a field's and a
    phrase's position."""
    fields = {"all": range(n_fields), "ti": range(n_fields)[:1], "abs": range(n_fields)[1:]}
    phrases: list[str] = []

    def test(field, phrase):
        if phrase not in phrases:
            phrases.append(phrase)
        pairs = [(f, phrases.index(phrase)) for f in fields[field]]
        return Test(lambda hits: any(p in hits for p in pairs))

    tests = []
    for spec in searches.values():
        found = [t for t in (expression_predicate(e, test) for e in spec["keywords"]) if t is not None]
        tests.append(reduce(lambda a, b: a | b, found, Test(lambda hits: False)).holds)
    return phrases, tests


def search_many(df: DataFrame, searches: dict[str, dict], as_of, text_cols=("title", "content"),
                authors_col: str = "author_names", date_col: str = "submitted_at", id_col: str = "id") -> DataFrame:
    """(search, rank, id) for each named search of the config's shape
    (``plans.search``): its newest ``max_results`` rows, ties by id; a search
    without ``max_results`` returns all its rows. Rows that repeat an id are rows
    of their own; a null date comes last."""
    names = list(searches)
    phrases, tests = compile_searches(searches, len(text_cols))
    limits = [searches[n].get("max_results") for n in names]

    def allowed(spec):
        out = F.lit(True)
        if spec.get("date_range"):
            out = out & date_range_predicate(date_col, spec["date_range"]["from"], spec["date_range"]["to"], as_of)
        if spec.get("authors"):
            out = out & has_any_author(authors_col, spec["authors"])
        return F.coalesce(out, F.lit(False))
    allow = [allowed(searches[n]) for n in names]
    rows = df.where(reduce(lambda a, b: a | b, allow, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("string").alias("id"),
                       F.unix_micros(F.col(date_col).cast("timestamp")).alias("at"), F.array(*allow).alias("allow"),
                       *[F.lower(F.col(c)).alias(f"text{i}") for i, c in enumerate(text_cols)])

    def order(row):
        return row[0] is None, -(row[0] or 0), row[1] is not None, row[1] or ""

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        machine = ahocorasick.Automaton()
        for i, p in enumerate(phrases):
            machine.add_word(p, i)
        if phrases:
            machine.make_automaton()
        best: list[list] = [[] for _ in names]
        schema = pa.schema([("search", pa.int32()), ("at", pa.int64()), ("id", pa.string())])

        def out(k, kept):
            return pa.RecordBatch.from_arrays([pa.array([k] * len(kept), pa.int32()), pa.array([r[0] for r in kept], pa.int64()),
                                               pa.array([r[1] for r in kept], pa.string())], schema=schema)
        for batch in batches:
            ids, at, allow_rows = (batch.column(i).to_pylist() for i in range(3))
            hits = [set() for _ in ids]
            for f in range(len(text_cols)):
                for found, text in zip(hits, batch.column(3 + f)):
                    text = text.as_py()
                    if text and phrases:
                        found.update((f, i) for _, i in machine.iter(text))
            for i in range(len(ids)):
                for k, holds in enumerate(tests):
                    if allow_rows[i][k] and holds(hits[i]):
                        best[k].append((at[i], ids[i]))
            for k, n in enumerate(limits):
                if n is None:                       # no limit: nothing is kept back
                    yield out(k, best[k])
                    best[k] = []
                elif len(best[k]) > n:
                    best[k] = heapq.nsmallest(n, best[k], key=order)
        for k in range(len(names)):
            yield out(k, best[k])

    found = rows.mapInArrow(run, "search int, at long, id string")
    newest = [F.col("at").desc_nulls_last(), F.col("id").asc()]
    limit = F.get(F.array(*[F.lit(n).cast("long") for n in limits]), F.col("search"))
    some = found.withColumn("limit", limit).where("limit is not null").withColumn(
        "group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    first = Window.partitionBy("search", "group").orderBy(*newest)
    last = Window.partitionBy("search").orderBy(*newest)
    most = max([n for n in limits if n is not None], default=0)
    top = (some.withColumn("r", F.row_number().over(first)).where(F.col("r") <= most).where("r <= limit")
           .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= most).where("rank <= limit"))
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("search")).alias("search")
    out = top.select(name, F.col("rank").cast("int").alias("rank"), "id")
    if None in limits:
        everything = found.withColumn("limit", limit).where("limit is null")
        out = out.unionByName(everything.select(name, F.lit(None).cast("int").alias("rank"), "id"))
    return out
