"""Importance resampling towards a target text, ranked by regular sampling.

Weights. Features are runs of 1 to ``longest`` consecutive words, each hashed
(crc32 of its bytes) to one of ``buckets``. Bucket counts of the documents and of
the target texts give an array of integer gains; a document's weight is the
floored mean of its features' gains, and its score adds Gumbel noise drawn from
its id, so that the highest scores are a sample without replacement.

Ranks, by parallel sorting by regular sampling:

1. every partition writes its rows in order, a locally sorted run with places;
2. rows at a regular distance in the runs are the samples, at most 2 *
   ``samples`` of them whatever the input, and every so many-th of the sorted
   samples is a splitter;
3. the splitters cut each run into segments; equal segments of all runs are
   exchanged to one task, which merges them and numbers its rows;
4. prefix sums of the segments' counts turn local numbers into exact ranks. Only
   segments that begin before the last drawn rank are exchanged at all.

Rows order by score (down), id, features, and a stored row number, so a segment
is cut between rows even when very many rows share an id or a score.

Defined cases: a null text has no words; no features weigh 0; a null id is drawn
with the empty string and comes last among ties; rows that repeat an id are rows
of their own; without target texts the gains compare with an empty target; an
empty table gives no rows; texts are handled in blocks of about 1 MB, whatever
their length; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import text_arrays as ta
from quire.llm.common import stage

#: Word bytes: digits, small letters and all bytes of non-ASCII characters.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words up to this length are hashed together, byte by byte; longer ones alone.
SHORT = 48


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_TABLE = _crc_table()


def extend(state: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The crc registers ``state`` after the bytes data[start : start + length]."""
    state = state.copy()
    todo = np.flatnonzero(length <= SHORT)
    todo = todo[np.argsort(length[todo], kind="stable")]
    ends = np.searchsorted(length[todo], np.arange(SHORT + 1), "right")
    for k in range(int(length[todo].max(initial=0))):
        rows = todo[ends[k]:]                       # the words longer than k bytes
        byte = data[start[rows] + k]
        state[rows] = _TABLE[(state[rows] ^ byte) & np.uint32(255)] ^ (state[rows] >> np.uint32(8))
    for i in np.flatnonzero(length > SHORT).tolist():
        crc = zlib.crc32(data[start[i]:start[i] + length[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF)
        state[i] = np.uint32(crc ^ 0xFFFFFFFF)
    return state


_SPACE = np.array([0x20], np.uint8)


def blocks(data: np.ndarray, most: int):
    """(from, to) stretches of about ``most`` bytes that cut no word."""
    at = 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data):
            gap = np.flatnonzero(~_INSIDE[_LOWER[data[end:end + 4096]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(data))
        yield at, end
        at = end


def features(column, buckets: int, longest: int = 1, most: int = 1 << 20):
    """Yields, per block and run length, (document, bucket) arrays of the features
    of an Arrow string column. Texts are cut into blocks; the last words of a
    block are carried into the next one, so runs of words cross it."""
    data, offsets = ta.raw(column)
    none = np.zeros(0, np.int64)
    tail = (none, none, none)                       # start, length, document of carried words
    for at, end in blocks(data, most):
        inside = _INSIDE[_LOWER[data[at:end]]]
        edge = offsets[np.searchsorted(offsets, at, "right"): np.searchsorted(offsets, end, "left")] - at
        first, final = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        final[:-1] &= ~inside[1:]
        first[edge], final[edge - 1] = inside[edge], inside[edge - 1]
        begin = np.flatnonzero(first)
        size = np.flatnonzero(final) - begin + 1
        begin = begin + at
        start = np.concatenate([tail[0], begin])
        length = np.concatenate([tail[1], size])
        of = np.concatenate([tail[2], np.searchsorted(offsets, begin, "right") - 1])
        new = len(tail[0])
        lo = int(start[0]) if len(start) else at
        low = _LOWER[data[lo:end]]
        state = extend(np.full(len(start), 0xFFFFFFFF, np.uint32), low, start - lo, length)
        for n in range(1, longest + 1):
            if n > 1:                               # runs of n words, by the place of their last one
                state = extend(state[:-1], _SPACE, np.zeros(max(0, len(state) - 1), np.int64),
                               np.ones(max(0, len(state) - 1), np.int64))
                state = extend(state, low, start[n - 1:] - lo, length[n - 1:])
            last = np.arange(n - 1, n - 1 + len(state))
            ok = (last >= new) & (of[last] == of[last - (n - 1)])
            bucket = ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)
            yield of[last][ok], bucket[ok]
        keep = max(0, len(start) - (longest - 1))
        tail = (start[keep:], length[keep:], of[keep:])


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """How often each bucket occurs; a task sends at most one row a bucket."""
    def run(batches):
        import pyarrow as pa

        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in ta.slices(batch, "text", 1 << 20):
                for _, b in features(part.column(0), buckets, longest):
                    n += np.bincount(b, minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():   # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Integer gain of each bucket: 1000 * the log ratio of smoothed shares."""
    s, t, k = source.astype(np.float64), target.astype(np.float64), float(len(source))
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + k)) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def noise(id_text: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256(seed:id)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of rows (doc_id, text)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, "text", 1 << 20):
                n = np.zeros(part.num_rows, np.int64)
                words, total = n.copy(), n.copy()
                for k, (doc, b) in enumerate(features(part.column(1), len(gain), longest)):
                    n += np.bincount(doc, minlength=len(n))
                    if k % longest == 0:
                        words += np.bincount(doc, minlength=len(n))
                    np.add.at(total, doc, gain[b])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(words), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_features", "n_words", "weight"])

    return docs.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


#: The order of the draw; ``row`` is a stored number of the row.
KEYS = ("score", "doc_id", "n_features", "row")


def splitters(runs: DataFrame, n: int, segments: int, samples: int) -> list[tuple]:
    """Keys that cut the sorted whole into about ``segments`` equal stretches."""
    step = max(1, -(-n // samples))
    picked = (runs.where((F.col("place") % step) == step // 2)
              .select(*[F.col(c) for c in KEYS]).collect())          # at most 2 * samples rows
    keys = sorted((-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["n_features"], r["row"]) for r in picked)
    cuts = sorted({i * len(keys) // segments for i in range(1, segments)}) if keys else []
    return [keys[i] for i in cuts if i]


def cut(runs: DataFrame, borders: list[tuple]) -> DataFrame:
    """``runs`` with the number of the segment that each row falls into."""
    def run(batches):
        import pyarrow as pa

        edge = [np.array(c, np.int64) for c in zip(*borders)] or [np.zeros(0, np.int64)] * 5
        for batch in batches:
            ids = batch.column("doc_id")
            cols = [-batch.column("score").to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    ids.fill_null(0).to_numpy(), batch.column("n_features").to_numpy(), batch.column("row").to_numpy()]
            both = [np.concatenate([e, c]) for e, c in zip(edge, cols)]
            # a border sorts before the row that equals it, which begins its segment
            order = np.lexsort((np.arange(len(both[0])) >= len(edge[0]), *both[::-1]))
            n_before = np.cumsum(order < len(edge[0]))
            segment = np.empty(len(order), np.int64)
            segment[order] = n_before
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment[len(edge[0]):])],
                                             [*batch.schema.names, "segment"])

    return runs.mapInArrow(run, "doc_id long, n_features long, weight long, score long, row long, segment long")


def resample(docs: DataFrame, target: DataFrame, id_col="doc_id", text_col="text", target_col="text",
             longest: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20, percent: int = 10,
             samples: int = 65_536, segment_rows: int = 16_384, most_segments: int = 4_096) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every row of ``docs``; rank 1,
    2, 3.. for the floor(percent * N / 100) best of the N with enough words."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(rows, "text", buckets, longest), bucket_counts(target, target_col, buckets, longest))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    scored = (weigh(rows, gain, longest)
              .withColumn("score", F.col("weight") + noise(id_text, seed))
              .withColumn("enough", F.col("n_words") >= least_words))
    # 1. sorted runs: a partition's rows in order, then numbered and written
    number = F.monotonically_increasing_id()
    runs = stage(scored.sortWithinPartitions(F.desc("enough"), F.desc("score"), F.col("doc_id").asc_nulls_last(),
                                             "n_features")
                 .select("doc_id", "n_features", "weight", "score", "enough", number.alias("row"))
                 .withColumn("place", F.col("row").bitwiseAND(F.lit((1 << 33) - 1))), "runs")
    able = runs.where("enough")
    n = able.count()
    take = percent * n // 100
    # 2. regular samples of the runs give the splitters
    segments = max(1, min(most_segments, -(-n // segment_rows)))
    borders = splitters(able, n, segments, samples) if segments > 1 else []
    placed = cut(able.select("doc_id", "n_features", "weight", "score", "row"), borders)
    # 4. prefix counts (one row a segment) tell where each segment begins
    counts = {r["segment"]: r["n"] for r in placed.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    before, at = {}, 0
    for s in sorted(counts):
        before[s], at = at, at + counts[s]
    wanted = [s for s in before if before[s] < take]
    none = F.lit(None).cast("long").alias("rank")
    cols = ["doc_id", "n_features", "weight", "score"]
    rest = runs.where(~F.col("enough")).select(*cols, none)
    if not wanted:
        return rest.unionByName(able.select(*cols, none))
    # 3. the segments that the draw reaches are exchanged, merged and numbered
    border = max(wanted)
    starts = F.array(*[F.lit(before.get(s, 0)).cast("long") for s in range(border + 1)])
    order = Window.partitionBy("segment").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "n_features", "row")
    local = F.row_number().over(order).cast("long")
    ranked = (placed.where(F.col("segment") <= border).withColumn("local", local)
              .withColumn("rank", F.col("local") + F.get(starts, F.col("segment").cast("int"))))
    ranked = ranked.select(*cols, F.when(F.col("rank") <= take, F.col("rank")).alias("rank"))
    return ranked.unionByName(placed.where(F.col("segment") > border).select(*cols, none)).unionByName(rest)
