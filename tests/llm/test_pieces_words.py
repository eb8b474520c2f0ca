"""Words that the encoder remembers, and what it makes of odd texts."""

import pytest

from quire.llm import pieces


def _model():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("piece_bpe_32k.model")


def test_a_common_word_is_segmented_once_among_many_others(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    coder, asked = pieces.Pieces(_model()), []
    viterbi = coder.viterbi
    monkeypatch.setattr(coder, "viterbi", lambda word: asked.append(word) or viterbi(word))
    said = [coder.encode(f"the other{i} the") for i in range(100)]
    assert asked.count("▁the") == 1 and len(asked) == 101
    fresh = pieces.Pieces(_model())
    for i in (0, 57, 99):
        words = [fresh.viterbi(w) for w in ("▁the", f"▁other{i}", "▁the")]
        assert said[i] == (sum((w[0] for w in words), []), sum(w[1] for w in words), sum(w[2] for w in words))


def test_few_words_are_remembered():
    known = pieces.Known(len, 10)
    assert [known[w] for w in map(str, range(1000))] == [len(str(i)) for i in range(1000)]
    assert len(known) + len(known.older) <= 10
    assert known["x" * 65] == 65 and "x" * 65 not in known


def test_pieces_of_odd_texts_round_trip(spark):
    texts = [None, "", " ", "  a", "a▁b", "漢字 é\n\n", "\x00", "▁", "<s> </s> <0x41>", " lead trail ", "x" * 200]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    coder = pieces.Pieces(_model())
    for r in pieces.encode(docs, _model()).collect():
        ids, score, n_bytes = coder.encode(r["text"] or "")
        assert (r["ids"], r["score"], r["n_byte_pieces"], r["n_pieces"]) == (ids, score, n_bytes, len(ids))
        assert r["round_trip"] == (coder.decode(ids) == (r["text"] or "").replace("▁", " "))
