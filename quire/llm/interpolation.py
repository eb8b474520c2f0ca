"""Language-model scoring by deleted interpolation.

P(w | v) = a(b) c(vw)/c(v) + b(b) c(w)/N + c(b) / (V + 1): maximum-likelihood
estimates of bigrams and unigrams and a uniform rest, mixed with weights that
depend on the bucket b = floor(log2(c(v) + 1)) of the context's frequency. The
weights are learned by expectation-maximisation on the part of the training
documents that is deleted from the counts for it (remainder ``part``); the
final counts are those of all training documents.

Data flow. Texts are read once, into chunks of some million tokens: token
sequences over the chunk's own word list. A chunk asks for the counts of its
distinct words and bigrams: sorted hash lists, cut by hash range into buckets,
so a word that makes a third of all text is one entry per chunk. A bucket adds
up and answers each chunk in its own order. What is gathered grows with the
input; nothing is collected but totals and the weights (about 40 buckets).

Defined cases: a null or empty text is the end token alone; a null id is held
out; rows that repeat count as often as they stand; a text of any length is one
sequence; with no training documents every token has probability 1 of the one
unknown word; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import text_arrays as ta
from quire.llm.common import lean, lean_call, remainder, stage

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
CHUNK_TOKENS = 1_000_000
#: Entries that a bucket should hold; the number of buckets follows the input.
BUCKET_ENTRIES = 750_000
BUCKETS = 48        # context-frequency buckets: counts up to 2 ** 47
#: A chunk's tokens are scored so many at a time (a longer text at once).
SCORED_TOKENS = 100_000


def pack(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    import zstandard

    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def pack_sorted(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct hashes, sorted; the place of each hash among them), in half of
    the memory that ``np.unique`` takes."""
    order = np.argsort(h)
    found = h[order]
    new = np.append(True, found[1:] != found[:-1])[:len(h)]
    at = np.empty(len(h), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return found[new], at


def pairs_of(words: np.ndarray, seq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token's bigram, local context of each token or -1 for the start)."""
    context = np.append(seq.dtype.type(-1), seq[:-1])
    context[first] = -1
    pair = words[context]
    pair[context < 0] = START
    pair *= np.uint64(0x9E3779B97F4A7C15)
    pair += ta.mix64(words)[seq]
    return ta.mix64(pair), context


def chunks(docs: DataFrame, part: int) -> DataFrame:
    """One row per chunk of documents; those of the deleted part (remainder
    ``part``) are in chunks of their own."""
    id_type = docs.schema["doc_id"].dataType

    def flush(number, em, held):
        import pyarrow as pa

        ids = pa.concat_arrays([h[0] for h in held])
        sizes = np.concatenate([h[1] for h in held])
        train = np.concatenate([h[2] for h in held])
        hashes = np.concatenate([h[3] for h in held])
        words, seq = distinct(hashes)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([em]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             *[pa.array([b], pa.binary()) for b in (pack(sizes.astype(np.int32)), pack(train.astype(np.uint8)),
                                                    pack(seq.astype(np.uint32)), pack_sorted(words))],
             pa.array([len(words)]), pa.array([len(seq)])],
            ["chunk", "em", "ids", "sizes", "train", "seq", "words", "n_words", "n_tokens"])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held = {True: [], False: []}
        tokens = {True: 0, False: 0}
        for batch in batches:
            for part_of in ta.slices(batch, "text"):
                r = np.asarray(part_of.column(2))
                w = ta.words(part_of.column(1))
                count = np.bincount(w.doc, minlength=part_of.num_rows)
                h = np.full(int((count + 1).sum()), END)
                h[np.arange(len(w.doc)) + w.doc] = w.hash      # one end token after each text
                for em in (True, False):
                    rows = np.flatnonzero((r == part) == em)
                    if not len(rows):
                        continue
                    keep = np.repeat((r == part) == em, count + 1)
                    held[em].append((part_of.column(0).take(pa.array(rows)), count[rows] + 1, r[rows] != 0, h[keep]))
                    tokens[em] += int(keep.sum())
                    if tokens[em] >= CHUNK_TOKENS:
                        yield flush(number, em, held[em])
                        number += 1
                        held[em], tokens[em] = [], 0
        for em in (True, False):
            if held[em]:
                yield flush(number, em, held[em])
                number += 1

    return docs.select("doc_id", "text", "r").mapInArrow(
        lean(run), f"chunk long, em boolean, ids array<{id_type.simpleString()}>, sizes binary, train binary, "
             "seq binary, words binary, n_words long, n_tokens long")


def _opened(row) -> tuple:
    """(words, seq, sizes, train flags per document, first token of each)."""
    sizes, train = unpack(row["sizes"], np.int32).astype(np.int64), unpack(row["train"], np.uint8).astype(bool)
    return (unpack_sorted(row["words"]), unpack(row["seq"], np.int32), sizes, train,
            np.cumsum(sizes) - sizes)


def requests(table: DataFrame, kind: str, buckets: int) -> DataFrame:
    """(bucket, chunk, em, h, n): the chunk's sorted distinct hashes of words or
    bigrams in the bucket's hash range, and their training counts."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                words, seq, sizes, train, first = _opened(row)
                use = np.repeat(train, sizes)
                if kind == "word":
                    h, n = words, np.bincount(seq[use], minlength=len(words))
                else:
                    pair, _ = pairs_of(words, seq, first)
                    h, at = distinct(pair)
                    n = np.bincount(at[use], minlength=len(h))
                to = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                cut = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
                some = [b for b in range(buckets) if cut[b] < cut[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([row["chunk"]] * len(some), pa.int64()),
                     pa.array([row["em"]] * len(some), pa.bool_()),
                     pa.array([pack_sorted(h[cut[b]:cut[b + 1]]) for b in some], pa.binary()),
                     pa.array([pack(n[cut[b]:cut[b + 1]].astype(np.uint32)) for b in some], pa.binary())],
                    ["bucket", "chunk", "em", "h", "n"])

    cols = ["chunk", "em", "sizes", "train", "seq", "words"]
    return table.select(*cols).mapInArrow(lean(run), "bucket long, chunk long, em boolean, h binary, n binary")


def answers(asked: DataFrame) -> DataFrame:
    """(chunk, bucket, em, total, rest, distinct, tokens, rest_tokens): for each request,
    the training counts of its entries, and without the deleted part; the
    bucket's sums of both are on its first row."""
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(b) for b in rows["h"]]
        counts = [unpack(b, np.uint32).astype(np.int64) for b in rows["n"]]
        cut = np.cumsum([0, *map(len, lists)])
        h, at = distinct(np.concatenate(lists))
        n = np.concatenate(counts)
        em = np.repeat(rows["em"].to_numpy(bool), np.diff(cut))
        total = np.bincount(at, n, len(h)).astype(np.int64)
        rest = total - np.bincount(at[em], n[em], len(h)).astype(np.int64)
        one = np.arange(len(rows)) == 0
        return pd.DataFrame({
            "chunk": rows["chunk"], "bucket": key[0], "em": rows["em"],
            "total": [pack(total[at[a:b]].astype(np.uint64)) for a, b in zip(cut, cut[1:])],
            "rest": [pack(rest[at[a:b]].astype(np.uint64)) if e else None for a, b, e in zip(cut, cut[1:], rows["em"])],
            "distinct": np.where(one, int((total > 0).sum()), 0), "tokens": np.where(one, int(total.sum()), 0),
            "rest_tokens": np.where(one, int(rest.sum()), 0)})

    return asked.groupBy("bucket").applyInPandas(
        lambda key, rows: lean_call(run, key, rows), "chunk long, bucket long, em boolean, total binary, rest binary, distinct long, tokens long, rest_tokens long")


def _gather(rows: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(counts of the chunk's words, of its bigrams), from its answers."""
    out = []
    for kind in ("word", "pair"):
        own = rows[rows["kind"] == kind].sort_values("bucket")
        out.append(np.concatenate([unpack(b, np.uint64) for b in own[column]]).astype(np.int64))
    return tuple(out)


def _token_counts(row, rows, column):
    """Per token: counts of its bigram, its context and itself."""
    words, seq, sizes, train, first = _opened(row)
    one, two = _gather(rows, column)
    pair, context = pairs_of(words, seq, first)
    at = distinct(pair)[1]
    del pair
    starts = int(one[np.searchsorted(words, END)])     # as many starts as ends
    return two[at], np.where(context < 0, starts, one[context]), one[seq], sizes, first


def learn_weights(counts: DataFrame, n: int, v: int, rounds: int = 20) -> np.ndarray:
    """(BUCKETS, 3) weights by expectation-maximisation over the held-out
    counts (c2, cv, cw, k): k held-out tokens with these deleted counts."""
    weight = np.full((BUCKETS, 3), 1 / 3)
    b = F.floor(F.log2(F.col("cv") + 1)).cast("int")
    p = [F.when(F.col("cv") > 0, F.col("c2") / F.col("cv")).otherwise(0.0),
         F.col("cw") / float(max(n, 1)), F.lit(1.0 / (v + 1))]
    data = stage(counts.select(b.alias("b"), *[x.alias(f"p{i}") for i, x in enumerate(p)], "k"), "heldout")
    for _ in range(rounds):
        part = [F.get(F.lit([float(x) for x in weight[:, i]]), F.col("b")) * F.col(f"p{i}") for i in range(3)]
        whole = part[0] + part[1] + part[2]
        rows = data.groupBy("b").agg(*[F.sum(F.col("k") * x / whole).alias(f"s{i}") for i, x in enumerate(part)]).collect()
        for r in rows:
            s = np.array([r["s0"], r["s1"], r["s2"]]) + 1e-3
            weight[r["b"]] = s / s.sum()
    return weight


def score(docs: DataFrame, id_col="doc_id", text_col="text", folds: int = 10, part: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; documents whose crc32 remainder by ``folds`` is 0 teach nothing."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        remainder(F.col(id_col), folds).cast("int").alias("r"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    table = stage(chunks(named, part), "chunks")
    size = table.agg(F.sum("n_words").alias("w"), F.sum("n_tokens").alias("t")).first()
    got = []
    for kind, entries in (("word", size["w"]), ("pair", size["t"])):
        asked = requests(table, kind, max(1, -(-(entries or 0) // BUCKET_ENTRIES)))
        got.append(stage(answers(asked).withColumn("kind", F.lit(kind)), f"answers-{kind}"))
    totals = got[0].agg(F.sum("distinct"), F.sum("tokens"), F.sum("rest_tokens")).first()
    v, n, n_rest = (int(x or 0) for x in totals)
    answered = got[0].unionByName(got[1]).select("chunk", "em", "bucket", "kind", "total", "rest")

    def heldout(key, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        c2, cv, cw, _, _ = _token_counts(rows.iloc[0], replies, "rest")
        # each count as its place among the chunk's: three places make one number
        code, values = np.zeros(len(c2), np.int64), []
        for c in (c2, cv, cw):
            value, at = distinct(c)
            code *= len(value)
            code += at
            values.append(value)
        code, k = np.unique(code, return_counts=True)
        code, at_w = np.divmod(code, len(values[2]))
        at_2, at_v = np.divmod(code, len(values[1]))
        return pd.DataFrame({"c2": values[0][at_2], "cv": values[1][at_v], "cw": values[2][at_w], "k": k})

    em_rows = table.where("em").drop("ids").groupBy("chunk")
    em_replies = answered.where("em").select(F.col("chunk").alias("of"), "bucket", "kind", "rest").groupBy("of")
    held = em_rows.cogroup(em_replies).applyInPandas(
        lambda key, rows, replies: lean_call(heldout, key, rows, replies), "c2 long, cv long, cw long, k long")
    weight = learn_weights(held.groupBy("c2", "cv", "cw").agg(F.sum("k").alias("k")), n_rest, v)

    def scored(key, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        c2, cv, cw, sizes, first = _token_counts(row, replies, "total")
        known, base, own = [], [], []
        i = 0
        while i < len(first):       # whole texts
            j = max(i + 1, int(np.searchsorted(first, first[i] + SCORED_TOKENS)))
            end = first[j] if j < len(first) else len(cw)
            two, of, one = (c[first[i]:end] for c in (c2, cv, cw))
            w = weight[np.floor(np.log2(of + 1.0)).astype(np.int64)]
            p = w[:, 0] * two / np.maximum(of, 1) + w[:, 1] * one / max(n, 1) + w[:, 2] / (v + 1)
            at = first[i:j] - first[i]
            known.append(np.add.reduceat((one > 0).astype(np.int64), at))
            base.append(np.add.reduceat(np.log10((one + 0.1) / (n + 0.1 * (v + 1))), at))
            own.append(np.add.reduceat(np.log10(p), at))
            i = j
        train = unpack(row["train"], np.uint8).astype(bool)
        return pd.DataFrame({
            "doc_id": list(row["ids"]), "held_out": ~train, "n_tokens": sizes,
            "n_known": np.concatenate(known), "train_tokens": n,
            "base_score": np.concatenate(base), "score": np.concatenate(own)})

    replies = answered.select(F.col("chunk").alias("of"), "bucket", "kind", "total").groupBy("of")
    return table.groupBy("chunk").cogroup(replies).applyInPandas(
        lambda key, rows, replies: lean_call(scored, key, rows, replies),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
