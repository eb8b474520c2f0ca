"""Language identification by a linear-chain conditional random field.

Every word of a text gets a language, jointly with its neighbours in the line:
emissions are weights of byte 3-grams (with word ends), affixes and the word
itself (the lexicon), and learned transitions say how readily a code-switched
line changes language. Forward-backward gives each word's distribution; a text
takes the language with the largest mean, which is its score.

Documents carry one label each, so training sequences are spliced from runs of
words of differently labelled texts: the transitions are learned from these.
The fit uses a bounded sample: at most ``fit_rows`` labelled pieces per language,
of at most ``piece_chars`` characters, drawn from all parts of all texts. A
language without a text with a word is not learned; the others are.

A prediction takes a text of any length whole (its arrays need some 40 bytes a
byte of the longest text of a slice). The model, broadcast, has ``SIZE`` floats a
language.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text when nothing was learned; ties go to the first language in code
point order; rows that repeat are labelled alike; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import text_arrays as ta
from quire.llm.common import WORD, lean, lean_call

GRAMS, LEXICON, AFFIX = 1 << 16, 1 << 16, 1 << 15
SIZE = GRAMS + LEXICON + AFFIX


class Model(NamedTuple):
    labels: list
    weight: np.ndarray   # (SIZE, languages)
    change: np.ndarray   # (languages, languages), log


class Features(NamedTuple):
    gram: np.ndarray     # bucket of the 3-gram around each word byte
    cut: np.ndarray      # where each word's 3-grams start
    other: np.ndarray    # (words, 3): lexicon, prefix, suffix


def features(w: ta.Words) -> Features:
    """Feature buckets of all words."""
    n = len(w.start)
    if not n:
        return Features(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3), np.int64))
    cut = np.cumsum(w.length) - w.length
    place = np.arange(int(w.length.sum())) - np.repeat(cut, w.length)
    # the words' bytes, with a 0 before each word and two after the last
    padded = np.zeros(len(place) + n + 2, np.uint32)
    at = place + np.repeat(cut + np.arange(n) + 1, w.length)
    padded[at] = w.data[place + np.repeat(w.start, w.length)]
    gram = (padded[at - 1] << np.uint32(16)) | (padded[at] << np.uint32(8)) | padded[at + 1]
    gram = ((gram + np.uint32(1)) * np.uint32(2654435761)) >> np.uint32(16)
    head = cut + np.arange(n) + 1
    tail = head + w.length - 1

    def code(i, j, k, salt):
        v = (padded[i] << np.uint32(16)) | (padded[j] << np.uint32(8)) | padded[k]
        return (((v + np.uint32(salt)) * np.uint32(2246822519)) >> np.uint32(17)).astype(np.int64)
    second = np.minimum(head + 1, tail + 1)
    third = np.minimum(head + 2, tail + 1)
    before = np.maximum(tail - 1, head - 1)
    before2 = np.maximum(tail - 2, head - 1)
    other = np.stack([GRAMS + (w.hash & np.uint64(LEXICON - 1)).astype(np.int64),
                      GRAMS + LEXICON + code(head, second, third, 0x3000001),
                      GRAMS + LEXICON + code(before2, before, tail, 0x7000003)], 1)
    return Features(gram.astype(np.int64), cut, other)


def emissions(f: Features, weight: np.ndarray) -> np.ndarray:
    if not len(f.cut):
        return np.zeros((0, weight.shape[1]), weight.dtype)
    return np.add.reduceat(weight[f.gram], f.cut, axis=0) + weight[f.other].sum(1)


def marginals(emit: np.ndarray, change: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """P(language) of every word by forward-backward over the sequences
    (first word, length), all sequences step by step together."""
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    step = np.exp(change - change.max())
    local = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64)
    alpha, beta = local.copy(), np.ones_like(local)
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")   # sequences longer than t
    for t in range(1, longest):
        at = first[:active[t]] + t
        a = (alpha[at - 1] @ step) * local[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    for t in range(longest - 1, 0, -1):
        at = first[:active[t]] + t
        b = (local[at] * beta[at]) @ step.T
        beta[at - 1] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    return both / both.sum(1, keepdims=True)


def lines(w: ta.Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of each line that has words."""
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.cumsum(w.data == 10)[w.start]
    new = np.append(True, (np.diff(line) != 0) | (np.diff(w.doc) != 0))
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(w.start)))


def studied(texts: list[str]) -> tuple[np.ndarray, Features]:
    """(text of each word, features of the words), some texts at a time: the arrays of
    words and places are some 40 times the text."""
    import pyarrow as pa

    doc, gram, cut, other, done = [], [], [], [], [0, 0]
    for part in ta.slices(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}), "text"):
        w = ta.words(part.column(0))
        f = features(w)
        doc.append((w.doc + done[0]).astype(np.int32))
        gram.append(f.gram.astype(np.uint16))       # buckets below GRAMS
        cut.append(f.cut + done[1])
        other.append(f.other.astype(np.int32))
        done = [done[0] + part.num_rows, done[1] + len(f.gram)]
    if not doc:
        return np.zeros(0, np.int32), features(ta.words(pa.array([], pa.string())))
    return np.concatenate(doc), Features(*(np.concatenate(x) for x in (gram, cut, other)))


def train(texts: list[str], labels: list, rounds: int = 400, batch: int = 64, length: int = 32,
          rate: float = 0.1, seed: int = 5) -> Model:
    """Maximum likelihood on spliced sequences by adaptive gradient steps."""
    doc, f = studied(texts)
    names = sorted({labels[i] for i in np.unique(doc)})     # those that have a word
    k = len(names)
    weight, change = np.zeros((SIZE, k), np.float32), np.zeros((k, k))
    per = [np.flatnonzero(np.isin(doc, [i for i, y in enumerate(labels) if y == name])) for name in names]
    if k < 2:
        return Model(names, weight, change)
    rng = np.random.default_rng(seed)
    size_of = np.diff(np.append(f.cut, len(f.gram)))
    g2w, g2c = np.full((SIZE, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(rounds):
        # splice: each run has 3 to 12 words; half of the runs change language
        pick, gold = np.zeros((batch, length), np.int64), np.zeros((batch, length), np.int64)
        for b in range(batch):
            t, y = 0, int(rng.integers(k))
            while t < length:
                n = min(int(rng.integers(3, 13)), length - t)
                start = int(rng.integers(max(1, len(per[y]) - n)))
                run = per[y][start:start + n]
                pick[b, t:t + len(run)], gold[b, t:t + len(run)] = run, y
                t += len(run)
                if rng.random() < 0.5:
                    y = int(rng.integers(k))
        ids = pick.ravel()
        n_gram = size_of[ids]
        cut = np.cumsum(n_gram) - n_gram
        gram = f.gram[np.arange(int(n_gram.sum())) - np.repeat(cut, n_gram) + np.repeat(f.cut[ids], n_gram)]
        part = Features(gram, cut, f.other[ids])
        emit = emissions(part, weight).astype(np.float64).reshape(batch, length, k)
        # forward-backward over the batch, with pair expectations for the transitions
        step = np.exp(change)
        local = np.exp(emit - emit.max(2, keepdims=True))
        alpha, beta = local.copy(), np.ones_like(local)
        alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
        for t in range(1, length):
            a = (alpha[:, t - 1] @ step) * local[:, t]
            alpha[:, t] = a / a.sum(1, keepdims=True)
        for t in range(length - 1, 0, -1):
            b = (local[:, t] * beta[:, t]) @ step.T
            beta[:, t - 1] = b / b.sum(1, keepdims=True)
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        pair = alpha[:, :-1, :, None] * step * (local * beta)[:, 1:, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        seen = np.zeros((k, k))
        np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        grad_c = (seen - pair.sum((0, 1))) / batch - 1e-3 * change
        p[np.arange(batch)[:, None], np.arange(length), gold] -= 1
        d = -p.reshape(-1, k) / batch
        grad = np.stack([np.bincount(part.gram, np.repeat(d[:, j], n_gram), SIZE)
                         + np.bincount(part.other.ravel(), np.repeat(d[:, j], 3), SIZE) for j in range(k)], 1)
        g2w += grad.astype(np.float32) ** 2
        g2c += grad_c ** 2
        weight += (rate * grad / np.sqrt(g2w)).astype(np.float32)
        change += rate * grad_c / np.sqrt(g2c)
    return Model(names, weight, change)


def has_letter(column, w: ta.Words) -> np.ndarray:
    """Which texts hold a letter of any script."""
    small = w.data | 32
    found = np.zeros(len(column), bool)
    at = np.flatnonzero((small >= 97) & (small <= 122))
    found[np.unique(np.searchsorted(w.offsets, at, "right") - 1)] = True
    for i in np.flatnonzero(~found & (np.diff(w.offsets) > 0)):
        found[i] = any(c.isalpha() for c in bytes(w.data[w.offsets[i]:w.offsets[i + 1]]).decode("utf-8", "replace"))
    return found


def label(column, model: Model) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, score, confidence) of each text of an Arrow string array: the
    score is the share of the language in the text, the confidence the mean of its
    words' best posteriors, high in a text that switches between known languages."""
    w = ta.words(column)
    n, k = len(column), len(model.labels)
    known = has_letter(column, w)
    if not k:
        return ["und"] * n, np.zeros(n), np.zeros(n)
    p = marginals(emissions(features(w), model.weight), model.change, *lines(w))
    count = np.maximum(np.bincount(w.doc, minlength=n), 1)
    mean = np.stack([np.bincount(w.doc, p[:, j], n) / count for j in range(k)], 1)
    best = mean.argmax(1)
    score = np.where(known, mean[np.arange(n), best], 0.0)
    sure = np.where(known, np.bincount(w.doc, p.max(1) if len(p) else None, n) / count, 0.0)
    names = [model.labels[b] if ok else "und" for b, ok in zip(best, known)]
    return names, np.clip(score, 0, 1), np.clip(sure, 0, 1)


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", fit_rows: int = 300,
        piece_chars: int = 12000) -> Model:
    """Model from a bounded sample of labelled rows.

    The rows are pieces of at most ``piece_chars`` characters, into which every
    text with a language is cut from its start to its end; pieces without a word
    are left out. Of each language the ``fit_rows`` pieces with the smallest hash
    of id, place and text are taken, wherever in whichever text they are. Rows
    that repeat id and text count once.
    """
    size = F.length("text")
    places = F.sequence(F.lit(0), F.greatest(F.ceil(size / piece_chars).cast("int") - 1, F.lit(0)))
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    d = d.where(F.col("lang").isNotNull() & F.col("text").rlike(WORD))
    d = d.select("id", "lang", F.posexplode(F.transform(places, lambda i: F.substring(
        F.col("text"), i * piece_chars + 1, F.lit(piece_chars)))).alias("place", "text"))
    d = d.where(F.col("text").rlike(WORD)).select("lang", "text", F.xxhash64("id", "place", "text").alias("h"))
    # a row limit per language, first in 64 parts of it; Spark applies it in each
    # task before the shuffle
    keys = d.select("lang", "h").withColumn("part", F.pmod(F.xxhash64("h"), F.lit(64))).distinct()
    for by in (("lang", "part"), ("lang",)):
        keys = keys.withColumn("r", F.row_number().over(
            Window.partitionBy(*by).orderBy("h"))).where(F.col("r") <= fit_rows)
    # as Arrow, for which executors start no Python workers of their own
    keys = docs.sparkSession.createDataFrame(keys.select("lang", "h").toArrow(), "lang string, h long")
    got = d.join(F.broadcast(keys), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    got.sort(key=lambda r: (r["lang"], r["h"]))
    texts, labels = [r["text"] for r in got], [r["lang"] for r in got]
    del got
    return lean_call(train, texts, labels)


def predict(docs: DataFrame, model: Model, text_col="text", as_columns=("lang_pred", "score", "confidence")) -> DataFrame:
    """All columns of ``docs`` (but those named ``as_columns``) and the three of the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))   # a few MB, fixed by the bucket count
    place = docs.columns.index(text_col)
    keep = [i for i, c in enumerate(docs.columns) if c not in as_columns]
    schema = docs.drop(*as_columns).schema.add(as_columns[0], "string").add(as_columns[1], "double").add(as_columns[2], "double")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, text_col, ta.FEW_BYTES):
                lang, p, sure = label(part.column(place), Model(*shared.value))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in keep] + [pa.array(lang, pa.string()), pa.array(p), pa.array(sure)],
                    schema.names)

    return docs.mapInArrow(lean(run), schema)
