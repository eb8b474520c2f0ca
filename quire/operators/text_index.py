"""Positional inverted index for phrase searches (B1).

Texts are lower-cased and cut at every single space, so a phrase of words with one
space between them occurs in a text exactly when consecutive tokens end with its
first word, equal its inner words and start with its last one; a phrase without a
space occurs when one token contains it. The index therefore gives the rows of
``filters.search_papers``, substring matches included.

Three versioned tables (``sinks.versions``) under one folder:

* ``postings`` (term, field, id, pos, batch), in hash buckets of the term;
* ``terms``: the distinct terms of each batch, in the same buckets;
* ``owners`` (id, batch): the batch that holds an id's current text, in hash
  buckets of the id.

A search finds the terms that can fill each place of its phrases in ``terms``
(some words a distinct one, not the texts), reads the postings of these terms'
buckets only, keeps those that fill a place, and lines the places up by position.
Only these are shuffled. ``add`` shuffles a batch's ids and distinct terms; its
postings, many times the text, are sorted and written by the tasks that read the
text (which is dealt anew where a task would have too much). ``add`` indexes a batch of
documents and leaves what is there as it is; a document that comes again in a
later batch belongs to that one. A batch that is added again changes nothing, and
one that failed half-way is completed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.search import expression_predicate
from quire.operators import upserts
from quire.operators.layout import stage, unstage
from quire.sinks.versions import BUCKET, VersionedTable, bucket_of

#: Bytes of text whose postings one task sorts (some 700 MB; it spills what it can't
#: hold), and of stored postings whose matches one task groups (some 150 MB).
TEXT_BYTES, POSTING_BYTES = 32 << 20, 4 << 20
_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
POSTINGS = T.StructType([T.StructField("term", _S), T.StructField("field", _I), T.StructField("id", _S),
                         T.StructField("pos", _I), T.StructField("batch", _L)])
TERMS = T.StructType([T.StructField("term", _S)])
OWNERS = T.StructType([T.StructField("id", _S), T.StructField("batch", _L)])


def occurrences(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(term, field, id, pos): one row per token of each field."""
    tokens = F.array(*[F.struct(F.lit(i).alias("field"), F.split(F.lower(F.col(c)), " ").alias("tokens"))
                       for i, c in enumerate(fields)])
    each = docs.select(F.col(id_col).alias("id"), F.inline(tokens))
    return each.select("id", "field", F.posexplode("tokens").alias("pos", "term")).select("term", "field", "id", "pos")


class TextIndex:
    def __init__(self, spark: SparkSession, root: str, fields: list[str], buckets: int = 64):
        self.fields, self.buckets = list(fields), buckets
        self.postings = VersionedTable(spark, f"{root}/postings", POSTINGS, key="term")
        self.terms = VersionedTable(spark, f"{root}/terms", TERMS, key="term")
        self.owners = VersionedTable(spark, f"{root}/owners", OWNERS)
        for t in (self.postings, self.terms, self.owners):
            t.create(buckets)

    def add(self, docs: DataFrame, batch: int, id_col: str = "id") -> None:
        """Index a batch of documents (of rows that repeat an id, one: the last
        by its values). Batches number the documents' versions: an id belongs to
        its highest batch, in whatever order batches are added."""
        given = one = stage(docs.select(F.col(id_col).alias("id"), *self.fields)
                            .withColumn("id", upserts.checked_key("id")), "to-index")
        repeated = stage(one.groupBy("id").count().where("count > 1").select("id"), "repeated")
        if not repeated.isEmpty():          # only rows that repeat an id are shuffled with their texts
            last = stage(upserts.latest_per_key(one.join(repeated, "id", "left_semi"), "id"), "to-index")
            one = one.join(repeated, "id", "left_anti").unionByName(last)
        size = one.agg(F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
                                                         for c in self.fields]))).first()[0] or 0
        tasks = 1 + size // TEXT_BYTES
        dealt = one.repartition(tasks, "id") if tasks > one.rdd.getNumPartitions() else one
        self.postings.append(occurrences(dealt, self.fields).withColumn("batch", F.lit(batch).cast("long")),
                             "index", batch, False)
        self.terms.append(occurrences(one, self.fields).select("term").distinct(), "index", batch, False)

        def own(old: DataFrame, new: DataFrame) -> DataFrame:
            return old.unionByName(new).groupBy("id").agg(F.max("batch").alias("batch"))
        self.owners.merge(one.select("id", F.lit(batch).cast("long").alias("batch")), own)
        unstage(given)

    def buckets_of(self, fills: Column) -> set[int]:
        """The buckets of the terms for which ``fills`` holds."""
        rows = self.terms.read().where(fills).select(bucket_of("term", self.buckets).alias(BUCKET))
        return {r[0] for r in rows.distinct().collect()}          # at most ``buckets`` rows

    def matches(self, phrases: list[tuple[tuple[int, ...], str]]) -> DataFrame:
        """(id, phrase): the documents where each (fields, phrase) occurs."""
        words = [p.split(" ") for _, p in phrases]
        places = [(k, j, w, "contains" if len(ws) == 1 else "ends" if j == 0 else
                   "starts" if j == len(ws) - 1 else "equals") for k, ws in enumerate(words) for j, w in enumerate(ws)]
        term = F.col("term")
        how = {"contains": term.contains, "ends": term.endswith, "starts": term.startswith, "equals": lambda w: term == w}
        tests = [(k, j, how[kind](F.lit(word))) for k, j, word, kind in places]
        fills = reduce(lambda a, b: a | b, [test for _, _, test in tests])
        used = self.buckets_of(fills)
        # (phrase, place) that the term can fill, in the scan: matching terms can be as many as new words
        fits = F.array(*[F.when(test, F.struct(F.lit(k).alias("phrase"), F.lit(j).alias("place"))) for k, j, test in tests])
        rows = self.postings.read(buckets=used).where(fills).select(
            "field", "id", "pos", "batch", F.inline(F.filter(fits, lambda x: x.isNotNull())))
        right_field = reduce(lambda a, b: a | b, [(F.col("phrase") == k) & F.col("field").isin(list(fs))
                                                  for k, (fs, _) in enumerate(phrases)])
        rows = rows.where(right_field).withColumn("start", F.col("pos") - F.col("place"))
        # a task's groups are those of a bounded share of the postings, however many there are
        rows = rows.repartition(1 + self.postings.stored_bytes(used) // POSTING_BYTES, "id")
        size = F.array(*[F.lit(len(ws)) for ws in words])
        # a token fills a place once, so a phrase is there when all its places are
        whole = (rows.groupBy("phrase", "id", "batch", "field", "start").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") == F.get(size, F.col("phrase"))))
        return (whole.select("id", "batch", "phrase").distinct()
                .join(self.owners.read(), ["id", "batch"], "left_semi").select("id", "phrase"))

    def search(self, expressions: list[str]) -> DataFrame:
        """(id): the documents for which any expression holds, as
        ``filters.search_papers`` finds them."""
        everywhere = tuple(range(len(self.fields)))
        where = {"all": everywhere, "ti": everywhere[:1], "abs": everywhere[1:]}
        phrases: list[tuple[tuple[int, ...], str]] = []

        def test(field, phrase):
            key = (where[field], phrase)
            if key not in phrases:
                phrases.append(key)
            return F.array_contains("phrases", phrases.index(key))
        found = [p for p in (expression_predicate(e, test) for e in expressions) if p is not None]
        if not found:
            return self.owners.read().select("id").where("false")
        # a document without any phrase fits no expression: ANDNOT only narrows
        per_id = self.matches(phrases).groupBy("id").agg(F.collect_set("phrase").alias("phrases"))
        return per_id.where(reduce(lambda a, b: a | b, found)).select("id")
