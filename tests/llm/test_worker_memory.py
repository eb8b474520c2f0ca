"""What a Python worker takes for the operators' arrays, and remembers."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import jaccard_join, language_crf, pieces, quality_classifier

TEXTS = [f"eins zwei drei vier wort{i} five{i % 7} " * 50 for i in range(2000)] + ["", None, "x"]


def _language(docs):
    weight = np.ones((language_crf.SIZE, 3), np.float32)
    return language_crf.predict(docs, language_crf.Model(["a", "b", "c"], weight, np.zeros((3, 3))))


def _quality(docs):
    weight = np.ones((2, quality_classifier.SIZE), np.float32)
    return quality_classifier.score(docs, quality_classifier.Model(weight, 0.0, 1.0, 0.0))


def _near_duplicates(docs):
    return jaccard_join.described(docs, 5, 80, np.zeros(0, np.uint64))


@pytest.mark.parametrize("operator, most_mb", [(_language, 12), (_quality, 24), (_near_duplicates, 10)])
def test_arrays_are_built_for_little_text_at_a_time(spark, monkeypatch, operator, most_mb):
    caught = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.mapInArrow",
                        lambda df, run, schema: caught.append(run) or df)
    operator(spark.createDataFrame([], "doc_id long, text string"))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    rows = 0
    tracemalloc.start()
    for out in caught[-1](iter([batch])):
        rows += out.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(TEXTS)
    assert peak < most_mb << 20


def test_a_remembered_word_takes_one_object():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    coder = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    coder.encode("warm up")
    tracemalloc.start()
    coder.encode(" ".join(f"word{i}" for i in range(20_000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(coder.known) > 20_000
    assert held < 230 * 20_000


def test_fits_start_no_workers_for_their_keys(spark, monkeypatch):
    """Rows given to ``createDataFrame`` as a list go through Python workers with a daemon of
    their own, which stay on the executors beside those of the operators."""
    docs = spark.createDataFrame([(i, "la vie est a nous" if i % 2 else "the life we live", "fr" if i % 2 else "en")
                                  for i in range(8)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    create, given = type(spark).createDataFrame, []
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: given.append(type(data)) or create(
        self, data, *a, **b))
    assert language_crf.fit(docs).labels == ["en", "fr"]
    assert quality_classifier.fit(docs, labels).slope != 0
    none = docs.where("false")
    assert language_crf.fit(none).labels == []
    assert quality_classifier.fit(none, labels.where("false")).slope == 0
    assert given and set(given) == {pa.Table}
