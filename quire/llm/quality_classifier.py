"""Quality classifier: Naive Bayes support vectors.

Indicators of byte 2- and 3-grams (and of immediate word repeats) are scaled
by the class log-count ratio r; a linear hinge-loss model on the scaled
indicators is fitted by dual coordinate descent, and a sigmoid fitted on rows
set aside turns its margin into a probability.

The fit uses a bounded sample of labelled rows (``fit_rows``, by hash order of
the id); scoring covers every row. An indicator is one of 65,536 buckets, so
the model is half a megabyte whatever the input.

Defined cases: a null or empty text has no n-grams and gets the score of the
bias alone; with one class or no labels the score is the smoothed share of
label 1; rows without a label or id don't teach; repeated rows count as often
as they stand; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import text_arrays as ta
from quire.llm.common import lean, lean_call

BUCKETS = 1 << 16
#: Two more indicators: a word twice, and three times, in a row.
SIZE = BUCKETS + 2


def indicators(column) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the n-grams of an Arrow string array, with repeats."""
    data, offsets = ta.raw(column)
    doc = np.repeat(np.arange(len(column)), np.diff(offsets))
    b = data.astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    h2 = ((two + np.uint32(0x5000000)) * np.uint32(2654435761)) >> np.uint32(16)
    h3 = ((three + np.uint32(1)) * np.uint32(2246822519)) >> np.uint32(16)
    ok2, ok3 = doc[:-1] == doc[1:], doc[:-2] == doc[2:]
    w = ta.words(column)
    same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    thrice = same[1:] & same[:-1]
    d2, d3 = w.doc[1:][same], w.doc[2:][thrice]
    return (np.concatenate([doc[:-1][ok2], doc[:-2][ok3], d2, d3]),
            np.concatenate([h2[ok2], h3[ok3], np.full(len(d2), BUCKETS), np.full(len(d3), BUCKETS + 1)]).astype(np.int64))


def present(column, most: int = 64):
    """Runs of ``most`` texts: (first, number of texts, text numbers, buckets),
    every bucket once per text."""
    for i in range(0, len(column), most):
        part = column.slice(i, most)
        doc, bucket = indicators(part)
        seen = np.zeros(len(part) * SIZE, bool)
        seen[doc * SIZE + bucket] = True
        at = np.flatnonzero(seen)
        yield i, len(part), at // SIZE, at % SIZE


class Model(NamedTuple):
    weight: np.ndarray   # float32 per bucket, the ratio multiplied in
    bias: float
    slope: float
    offset: float


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
            c: float = 1.0, epochs: int = 15, seed: int = 7) -> np.ndarray:
    """Dual coordinate descent for the L2-regularised hinge loss."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    square = np.array([float(v @ v) for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            if square[i] == 0:
                continue
            g = y[i] * float(w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), c)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
    return w


def sigmoid_fit(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, offset) of P(1 | margin), with Platt's smoothed targets."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-3 * b)
        b = b + np.clip(step, -2, 2)
    return float(b[0]), float(b[1])


def train(samples: list[tuple[np.ndarray, int]]) -> Model:
    """samples: (buckets of a text, label 0 or 1), in a fixed order."""
    label = np.array([s[1] for s in samples], int)
    n1, n0 = int((label == 1).sum()), int((label == 0).sum())
    if not n1 or not n0:
        p = (n1 + 1) / (n1 + n0 + 2)
        return Model(np.zeros(SIZE, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))
    aside = np.arange(len(samples)) % 4 == 3
    if len(set(label[aside])) < 2 or len(set(label[~aside])) < 2:
        aside[:] = False
    pos, neg = np.ones(SIZE), np.ones(SIZE)
    for (f, y), skip in zip(samples, aside):
        if not skip:
            np.add.at(pos if y else neg, f, 1)
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())

    def values(f):  # scaled indicators of unit length, and the bias
        v = ratio[f]
        return np.append(v / max(float(np.sqrt(v @ v)), 1e-9), 1.0)
    rows = [np.append(s[0], np.int32(SIZE)) for s in samples]
    vals = [values(s[0]) for s in samples]
    y = np.where(label == 1, 1.0, -1.0)
    use = np.flatnonzero(~aside)
    w = descend([rows[i] for i in use], [vals[i] for i in use], y[use], SIZE + 1)
    test = np.flatnonzero(aside) if aside.any() else use
    slope, offset = sigmoid_fit(np.array([float(w[rows[i]] @ vals[i]) for i in test]), y[test])
    return Model(np.stack([ratio * w[:-1], ratio * ratio]).astype(np.float32), float(w[-1]), slope, offset)


def probabilities(column, model: Model) -> np.ndarray:
    out = np.zeros(len(column))
    for i, n, doc, bucket in present(column):
        if model.weight.ndim == 2:
            dot = np.bincount(doc, model.weight[0][bucket], n)
            length = np.sqrt(np.bincount(doc, model.weight[1][bucket], n))
            out[i:i + n] = dot / np.maximum(length, 1e-9) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * out + model.offset, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
        fit_rows: int = 5000) -> Model:
    """Model from at most ``fit_rows`` rows of ``labels`` (label 0 or 1), each with
    one text: of rows that repeat an id, the one with the smallest features."""
    spark = docs.sparkSession
    order = F.xxhash64(F.col(id_col).cast("string"))
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), order.alias("h"))
              .where("id is not null and y in (0, 1)").orderBy("h", "id", "y").limit(fit_rows))
    # at most fit_rows rows; as Arrow, for which executors start no Python workers of their own
    picked = spark.createDataFrame(picked.toArrow(), picked.schema)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id").select("h", "id", "y", "text")

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, "text", ta.FEW_BYTES):
                text = part.column(3)
                found = []
                for _, n, doc, bucket in present(text):
                    cut = np.searchsorted(doc, np.arange(n + 1))
                    found += [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(found, pa.binary())],
                    ["h", "id", "y", "f"])

    id_type = docs.schema[id_col].dataType.simpleString()
    # one row a label: of rows that repeat an id, the smallest by its features
    got = (rows.mapInArrow(lean(vectors), f"h long, id {id_type}, y int, f binary")
           .groupBy("h", "id", "y").agg(F.min("f").alias("f")).collect())
    got.sort(key=lambda r: (r["h"], str(r["id"]), r["y"], bytes(r["f"])))
    samples = [(np.frombuffer(r["f"], np.int32), r["y"]) for r in got]
    del got
    return lean_call(train, samples)


def score(docs: DataFrame, model: Model, text_col="text", as_column="score") -> DataFrame:
    """All columns of ``docs`` and ``as_column``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))   # about half a megabyte
    place = docs.columns.index(text_col)
    schema = docs.drop(as_column).schema.add(as_column, "double")
    keep = [i for i, c in enumerate(docs.columns) if c != as_column]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, text_col, ta.FEW_BYTES):
                p = probabilities(part.column(place), Model(*shared.value))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in keep] + [pa.array(p)], schema.names)

    return docs.mapInArrow(lean(run), schema)
