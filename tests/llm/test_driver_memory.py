"""What learning and collecting take in the driver's Python process."""

import tracemalloc

import numpy as np
import pyarrow as pa

from quire.llm import jaccard_join, language_crf
from quire.llm import text_arrays as ta


def test_training_texts_are_read_some_at_a_time():
    texts = [f"eins zwei drei wort{i} " * 100 for i in range(1000)] + ["", "x"]
    size = sum(map(len, texts))
    tracemalloc.start()
    doc, f = language_crf.studied(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * size         # all at once it was 48 times the text
    w = ta.words(pa.array(texts, pa.string()))
    whole = language_crf.features(w)
    assert (doc == w.doc).all() and all((a == b).all() for a, b in zip(f, whole))
    assert len(language_crf.studied([])[0]) == 0


def test_frequent_shingles_come_as_arrow(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e f{i}") for i in range(6)], "doc_id long, text string")
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.collect", _no_hashes(spark))
    hot = jaccard_join.hot_shingles(docs, 5, 100)
    assert hot.dtype == np.uint64 and len(hot) == 1 and (hot == np.sort(hot)).all()


def _no_hashes(spark):
    """``collect`` that refuses rows of hashes: each takes some 100 bytes in the driver."""
    collect = type(spark.range(1)).collect

    def checked(df):
        assert df.columns != ["h"]
        return collect(df)
    return checked
