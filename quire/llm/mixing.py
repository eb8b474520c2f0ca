"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix is the golden-ratio point i * phi (mod 1), kept as an exact
31-bit integer, mapped through the sources' cumulative target shares. So every
stretch of the schedule holds each source in close proportion to its target.
The slots of a source are ranked, and rank r takes block (r - 1) mod n of that
source's shuffled text, cut into n blocks of equal tokens (one more or less). A
source gets as many slots as its target holds of its own blocks: the few that the
schedule gives beyond that stay empty, the few that it lacks follow at the end.
Sources of few words have blocks of few words, so their targets are met as well.
Shuffling is by the md5 of the document id, so a rerun gives the same mix.

Defined cases: a null or wordless text has size 0 and is never taken; a null
source is one source of its own, last in order; rows that repeat a doc_id are
documents of their own; an empty table gives an empty mix. Columns other than
the id, source and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, stage

#: 2**31 and the odd number nearest to 2**31 / golden ratio: i * STEP mod SPAN
#: visits every residue once and is the golden-ratio sequence to 31 bits.
SPAN = 1 << 31
STEP = 1327217885
#: Shares are looked up in so many equal intervals of [0, 1).
BINS = 4096
#: Slots per ranking segment, and segments per group of them: no window is longer.
SEGMENT = 2048
#: A source of at least so many words has at least so many blocks.
LEAST_BLOCKS = 16


def sizes(docs: DataFrame, id_col="doc_id", source_col="source", text_col="text") -> DataFrame:
    """(doc_id, source, size): size is the number of words."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights=(1, 2, 3), limit: int = 3, block_tokens: int = 32) -> DataFrame:
    """One row per source: pos (order by code point, null last), source_size,
    target, n_blocks, slots (its target in blocks of its own), all_slots, and
    lo / hi, its interval of [0, SPAN).

    The targets share the total by weight; none exceeds ``limit`` times its
    source, and the excess is shared again by weight. In order of cap / weight
    the capped sources come first, so running sums give the share per weight
    that is left, without iterating. Windows here run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cap = limit * F.col("source_size")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.col("pos") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("pos", F.row_number().over(order)).withColumn("w", w.cast("long"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("w"), "pos")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    per = (per.withColumn("cap", cap)
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
              .withColumn("w_left", F.sum("w").over(everything)
                          - F.coalesce(F.sum("w").over(earlier), F.lit(0))))
    per = per.withColumn("rate", F.col("left").cast("double") / F.col("w_left"))
    # The first source in cap order that the remaining rate doesn't fill sets the rate.
    rate = F.min_by("rate", F.when(F.col("cap") >= F.col("rate") * F.col("w"),
                                   F.struct(F.col("source_size") / F.col("w"), "pos"))).over(everything)
    per = per.withColumn("target", F.least(F.col("cap").cast("double"),
                                           F.coalesce(rate * F.col("w"), F.col("cap").cast("double"))))
    per = per.withColumn("n_blocks", F.greatest(F.ceil(F.col("source_size") / block_tokens),
                                                F.least(F.col("source_size"), F.lit(LEAST_BLOCKS))))
    per = per.withColumn("slots", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") * F.col("n_blocks") / F.col("source_size") + 0.5)).otherwise(0).cast("long"))
    per = per.withColumn("all_slots", F.sum("slots").over(everything))
    cum = F.sum("slots").over(Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    share = cum.cast("double") / F.col("all_slots").cast("double")
    per = per.withColumn("hi", F.when(F.col("all_slots") > 0, F.round(share * SPAN)).otherwise(0).cast("long"))
    lo = F.coalesce(F.lag("hi").over(Window.orderBy("pos")), F.lit(0))
    return per.withColumn("lo", lo).select("source", "pos", "w", "source_size", "target", "total", "n_blocks", "slots",
                                           "all_slots", "lo", "hi")


def schedule(shares: DataFrame, n_slots: int) -> DataFrame:
    """(slot, pos, rank): the source of every slot and the slot's rank in it."""
    spark = shares.sparkSession
    width = SPAN // BINS
    spans = (shares.where("hi > lo")
             .select("pos", "lo", "hi", F.explode(F.sequence(
                 F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("bin")))
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), (((F.col("id") + 1) % SPAN) * STEP % SPAN).alias("x"))
    mapped = (slots.withColumn("bin", F.floor(F.col("x") / width))
              .join(spans, "bin").where("x >= lo and x < hi")
              .select("slot", "pos", F.floor(F.col("slot") / SEGMENT).alias("seg")))
    counts = mapped.groupBy("pos", "seg").agg(F.count("*").alias("n"))
    # running sums in two levels: groups of segments, then the segments of a group
    counts = counts.withColumn("group", F.floor(F.col("seg") / SEGMENT))
    rows_before = (Window.unboundedPreceding, -1)
    groups = counts.groupBy("pos", "group").agg(F.sum("n").alias("g"))
    groups = groups.select("pos", "group", F.coalesce(F.sum("g").over(
        Window.partitionBy("pos").orderBy("group").rowsBetween(*rows_before)), F.lit(0)).alias("g_before"))
    inner = F.coalesce(F.sum("n").over(
        Window.partitionBy("pos", "group").orderBy("seg").rowsBetween(*rows_before)), F.lit(0))
    before = counts.withColumn("inner", inner).join(groups, ["pos", "group"]).select(
        "pos", "seg", (F.col("inner") + F.col("g_before")).alias("before"))
    within = mapped.withColumn("r", F.row_number().over(Window.partitionBy("pos", "seg").orderBy("slot")))
    return within.join(before, ["pos", "seg"]).select("slot", "pos", (F.col("r") + F.col("before")).alias("rank"))


def stream(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """Each sized document's place (start) in its source's shuffled text.

    Running sums are in two levels, (source, md5 prefix) and then the rows of
    a prefix, so a source with a third of all rows is spread over 4,096 groups.
    """
    key = shares.select("pos", F.col("source").alias("s_source"))
    d = sized.join(key, F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
    d = (d.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
          .withColumn("part", F.substring("h", 1, 3)))
    sums = d.groupBy("pos", "part").agg(F.sum("size").alias("s"))
    before = sums.select("pos", "part", F.coalesce(F.sum("s").over(
        Window.partitionBy("pos").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    inner = Window.partitionBy("pos", "part").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return d.join(before, ["pos", "part"]).select(
        "doc_id", "pos", "size", (F.col("before") + F.col("inner")).alias("start"))


def mix(docs: DataFrame, id_col="doc_id", source_col="source", text_col="text", weights=(1, 2, 3),
        limit: int = 3, block_tokens: int = 32) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per document.

    ``taken`` counts the words of the document that the mix takes, repeats
    included: at most ``limit`` passes over a source, so at most ``limit``
    times the size. A slot of a source that would need another pass stays empty.
    """
    sized = stage(sizes(docs, id_col, source_col, text_col), "sizes")
    shares = stage(targets(sized, weights, limit, block_tokens), "shares")
    n_slots = shares.agg(F.max("all_slots")).first()[0] or 0
    quota = shares.select("pos", "n_blocks", "slots")
    ranked = stage(schedule(shares, n_slots).select("pos", "rank"), "slots")
    had = ranked.groupBy("pos").agg(F.count("*").alias("had"))
    # what a source's schedule lacks of its quota: a few slots, by the sequence's low discrepancy
    late = (quota.join(had, "pos", "left").withColumn("had", F.coalesce("had", F.lit(0)))
            .where("had < slots").select("pos", F.explode(F.sequence(F.col("had") + 1, F.col("slots"))).alias("rank")))
    times = (ranked.unionByName(late).join(quota, "pos").where("rank <= slots")
             .groupBy("pos", ((F.col("rank") - 1) % F.col("n_blocks")).alias("block"))
             .agg(F.count("*").alias("times")))
    # block j begins at j * base + min(j, extra): the first blocks hold one word more
    cut = shares.where("source_size > 0").select(
        "pos", F.expr("source_size div n_blocks").alias("base"), F.expr("source_size % n_blocks").alias("extra"))
    placed = stream(sized.where("size > 0"), shares).join(cut, "pos")

    def block_of(word):
        return (f"case when {word} < extra * (base + 1) then {word} div (base + 1) "
                f"else extra + ({word} - extra * (base + 1)) div base end")
    pieces = (placed.withColumn("block", F.explode(F.sequence(
                  F.expr(block_of("start")), F.expr(block_of("(start + size - 1)")))))
              .withColumn("part", F.expr("least(start + size, (block + 1) * base + least(block + 1, extra)) "
                                         "- greatest(start, block * base + least(block, extra))")))
    taken = (pieces.join(times, ["pos", "block"], "left")
             .groupBy("doc_id", "pos", "start", "size")
             .agg(F.sum(F.col("part") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
             .select("doc_id", "pos", "size", "taken"))
    key = shares.select("pos", "source", "source_size", "target")
    none = (sized.where("size = 0").join(key.withColumnRenamed("source", "s_source"),
                                         F.col("source").eqNullSafe(F.col("s_source")))
            .select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))
    return taken.join(key, "pos").select(
        "doc_id", "source", "size", "source_size", "target", "taken").unionByName(none)
