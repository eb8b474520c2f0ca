"""Shared helpers: words, learning splits, staged tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.layout import lean, lean_call, stage  # noqa: F401  (the operators import them from here)

#: A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; 0 for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(0))


#: Keys of at most so many rows (some 16 bytes each) are broadcast.
BROADCAST_ROWS = 1_000_000


def narrow(keys: DataFrame) -> DataFrame:
    """A written table of keys to join a wide table with: broadcast when it has
    at most ``BROADCAST_ROWS`` rows, joined by shuffle otherwise."""
    keys = stage(keys, "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; a component is
    named by its smallest node.

    Large-star / small-star: each round links a node's neighbours to their
    minimum, so a node with very many neighbours is an aggregate and a join
    (which adaptive execution can split), never a collected list. Every round
    is a written table; the rounds end when a round changes nothing.
    """
    def symmetric(e):
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, large):
        both = symmetric(e) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        linked = both.join(least, "a")
        if large:
            out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e):
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                    .alias("h")).first()
        return row["n"], row["h"]

    now = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = mark(now)
    while True:
        now = stage(star(star(now, True), False), "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
