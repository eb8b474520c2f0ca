"""The operators against brute force, and on odd rows and empty tables."""

import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quire.llm import (interpolation, jaccard_join, language_crf, mixing, pieces, quality_classifier,
                       quality_rules, text_arrays, token_counts, topk, warc)
from quire.llm.common import components
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def words(text, lower=True):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


# ------------------------------------------------------------------ helpers

def test_words_of_arrow_strings():
    import pyarrow as pa
    texts = ["The the\x0bTHE x", None, "", "  ", "Été  y", "a"]
    for col in (pa.array(texts), pa.array(["skip", *texts])[1:], pa.array(texts, pa.large_string())):
        w = text_arrays.words(col)
        got = [[] for _ in texts]
        for d, s, n in zip(w.doc, w.start, w.length):
            got[d].append(bytes(w.data[s:s + n]).decode())
        assert got == [words(t) for t in texts]
        assert len(set(w.hash[:3])) == 1 and len(set(w.hash)) == len({x for t in texts for x in words(t)})


def test_components_are_smallest_nodes(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 450)]
    edges += [(1000, 1001 + i) for i in range(300)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in parent}


# ------------------------------------------------------------ 1 quality rules

def test_rules_features_by_brute_force(spark, odd_docs):
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in quality_rules.features(odd_docs).collect())
    want = []
    for row in odd_docs.collect():
        t, w = row.text or "", words(row.text, False)
        seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)))
    assert got == sorted(want)


def planted(n, hits, alarms, share, seed=21):
    """Votes of independent rules with known rates: (rows, quality)."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < share
    cols = [np.where(good, rng.choice([-1, 0, 1], n, p=a), rng.choice([-1, 0, 1], n, p=h)) for h, a in zip(hits, alarms)]
    return [tuple(int(c[i]) for c in cols) for i in range(n)], good


def test_rates_of_planted_rules_are_recovered(spark):
    """Rules that only raise alarms, rules that vote both ways, a useless one."""
    hits = [(.7, .3, 0), (.5, .3, .2), (.3, .7, 0), (.6, .2, .2), (.1, .6, .3), (.8, .15, .05)]        # on bad texts: -1, 0, 1
    alarms = [(.02, .98, 0), (.1, .3, .6), (.05, .95, 0), (.05, .15, .8), (.1, .6, .3), (.1, .2, .7)]   # on good texts
    rows, good = planted(20_000, hits, alarms, 0.8)
    names = [f"v{j}" for j in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    rate_good, rate_bad, share = quality_rules.fit(df, names, rounds=60)
    assert abs(share - 0.8) < 0.05
    assert np.abs(np.array(rate_good).reshape(6, 3) - np.array(alarms)).max() < 0.05
    assert np.abs(np.array(rate_bad).reshape(6, 3) - np.array(hits)).max() < 0.05
    assert quality_rules.fit(df.where("false"), names)[2] == pytest.approx(0.8)


def test_rules_of_empty_and_odd_tables(spark, odd_docs, no_docs):
    assert quality_rules.score(no_docs).count() == 0 and interpolation.score(no_docs).count() == 0
    rows = quality_rules.score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(not r.kept for r in rows if r.n_words < 10) and all(0 <= r.posterior <= 1 for r in rows)


def test_rules_separate_prose_from_junk(spark, prose):
    good = [(i, prose("aa", 80)) for i in range(200)]
    junk = [(1000 + i, " | ".join(prose("aa", 40).split())) for i in range(20)]
    junk += [(2000 + i, prose("bb", 60).upper().replace(" ", "!! ")) for i in range(20)]
    kept = {r.doc_id for r in quality_rules.score(spark.createDataFrame(good + junk, "doc_id long, text string"))
            .where("kept").collect()}
    assert len(kept & {g[0] for g in good}) > 195 and not kept & {j[0] for j in junk}


# ------------------------------------------------------------ 2 interpolation

def test_language_model_by_brute_force(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                 for r in interpolation.score(odd_docs).collect())

    def rest(d):
        return 0 if d is None else zlib.crc32(str(d).encode()) % 10
    docs = [(r.doc_id, rest(r.doc_id), [*words(r.text), None]) for r in rows]

    def counts(keep):
        one, two = collections.Counter(), collections.Counter()
        for _, r, w in docs:
            if keep(r):
                one.update(w)
                two.update(zip(["<s>", *w], w))
        one["<s>"] = one[None]
        return one, two, sum(n for x, n in one.items() if x != "<s>")
    one, two, n = counts(lambda r: r != 0)
    part1, part2, part_n = counts(lambda r: r not in (0, 1))
    v = len([x for x in one if x != "<s>" and one[x]])
    weight = np.full((48, 3), 1 / 3)
    held = [(part2[p], part1[p[0]], part1[p[1]]) for _, r, w in docs if r == 1 for p in zip(["<s>", *w], w)]
    for _ in range(20):
        total = collections.defaultdict(lambda: np.zeros(3))
        for c2, cv, cw in held:
            b = int(math.log2(cv + 1))
            p = weight[b] * [c2 / cv if cv else 0, cw / max(part_n, 1), 1 / (v + 1)]
            total[b] += p / p.sum()
        for b, s in total.items():
            weight[b] = (s + 1e-3) / (s + 1e-3).sum()
    want = []
    for d, r, w in docs:
        s = sum(math.log10(weight[int(math.log2(one[a] + 1))] @ [
            two[a, b] / max(one[a], 1), one[b] / n, 1 / (v + 1)]) for a, b in zip(["<s>", *w], w))
        base = sum(math.log10((one[x] + .1) / (n + .1 * (v + 1))) for x in w)
        want.append((str(d), r == 0, len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(s, 6)))
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want)]
    for g, w in zip(got, sorted(want)):
        assert g[5:] == pytest.approx(w[5:], rel=1e-6)


# ------------------------------------------------------------------ 3 the CRF

def test_marginals_by_enumeration():
    import itertools
    rng = np.random.default_rng(2)
    emit, change = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    got = language_crf.marginals(emit, change, np.array([0, 4, 5]), np.array([4, 1, 4]))
    for first, n in ((0, 4), (4, 1), (5, 4)):
        p = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            s = sum(emit[first + i, y] for i, y in enumerate(path)) + sum(change[a, b] for a, b in zip(path, path[1:]))
            for i, y in enumerate(path):
                p[i, y] += math.exp(s)
        assert np.allclose(got[first:first + n], p / p.sum(1, keepdims=True))


def test_crf_labels_code_switched_words(prose):
    import pyarrow as pa
    model = language_crf.train([prose("aa", 200) for _ in range(5)] + [prose("bb", 200) for _ in range(5)],
                               ["aa"] * 5 + ["bb"] * 5, rounds=80)
    mixed = pa.array([prose("aa", 10) + " " + prose("bb", 10)])
    w = text_arrays.words(mixed)
    p = language_crf.marginals(language_crf.emissions(language_crf.features(w), model.weight), model.change,
                               *language_crf.lines(w))
    assert (p.argmax(1) == [0] * 10 + [1] * 10).mean() > 0.9


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = language_crf.fit(odd_docs)
    rows = language_crf.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in ("aa", "bb") and 0 < r.score <= 1
    assert all(0 <= r.confidence <= 1 and r.confidence >= r.score - 1e-9 for r in rows)
    right = [r.lang_pred == r.lang for r in rows if r.doc_id and r.doc_id >= 20]
    assert sum(right) / len(right) > 0.95
    assert language_crf.predict(no_docs, language_crf.fit(no_docs)).count() == 0
    nothing = language_crf.predict(odd_docs, language_crf.fit(no_docs))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_language_without_words_is_left_out(spark, prose):
    texts = [prose(lang, 60) for lang in ("aa", "bb") for _ in range(6)]
    model = language_crf.train(texts + [" \n", "\t"], ["aa"] * 6 + ["bb"] * 6 + ["cc"] * 2, rounds=40)
    assert model.labels == ["aa", "bb"] and model.weight.any()
    assert language_crf.train([" ", "\n"], ["aa", "bb"]).labels == []
    # blank texts don't use up the rows of a language either
    words_of = {"aa": lambda: prose("aa", 60), "bb": lambda: prose("bb", 60), "cc": lambda: "quo vadis domine " * 20}
    rows = [(i, words_of[lang](), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 4)]
    rows += [(100 + i, " \n" * i, lang) for i in range(1, 60) for lang in ("cc", "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.fit(docs, fit_rows=4)
    assert model.labels == ["aa", "bb", "cc"] and model.weight.any()


def test_language_sample_covers_whole_texts_and_one_hot_id(spark, prose, monkeypatch):
    """Pieces come from every part of a long text; a row that repeats is one
    piece, so the driver gets no more than its limit."""
    seen = []
    monkeypatch.setattr(language_crf, "train", lambda texts, langs: seen.append((texts, langs)))
    body = " ".join(f"w{i}" for i in range(4000))
    rows = [(7, prose("aa", 40), "aa")] * 500 + [(1, body, "bb")] + [(100 + i, prose("aa", 40), "aa") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    language_crf.fit(docs, fit_rows=20, piece_chars=1000)
    texts, langs = seen[0]
    assert langs.count("aa") == 20 and len(set(texts)) == len(texts)
    own = [t for t, lang in zip(texts, langs) if lang == "bb"]
    assert len(own) == 20 and all(t in body for t in own)
    assert max(body.index(t) for t in own) > 15_000                   # not only the beginning


def test_crf_accuracy_on_held_out_rows(spark):
    """Trained on the rows of the split, told apart on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    from quire.llm.common import remainder
    held = remainder(F.col("doc_id"), 3) == 1
    told = language_crf.predict(docs.where(held), language_crf.fit(docs.where(~held))).where("text rlike '[a-z]'").collect()
    assert len(told) > 250 and sum(r.lang_pred == r.lang for r in told) >= 0.98 * len(told)


def test_language_of_long_texts_only_is_learned(spark, prose):
    rows = [(i, prose("aa", 60), "aa") for i in range(8)]
    rows += [(20 + i, " " * 600 * (i % 2) + prose("bb", 400), "bb") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.fit(docs, fit_rows=6, piece_chars=500)
    assert model.labels == ["aa", "bb"]
    assert all(r.lang_pred == r.lang for r in language_crf.predict(docs, model).collect())


# --------------------------------------------------------------------- 4 top-k

@pytest.mark.parametrize("scale", [1.0, 40.0])
def test_topk_by_brute_force(spark, scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)) * rng.exponential(scale, size=(400, 1))
    x[50:90] = x[0]                                       # ties
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(900, None), (920, [None] * 6), (940, [math.nan] * 6), (960, []), (980, [1.0, 2.0]), (None, rows[1][1])]
    rows += [(40, rows[40][1]), (41, rows[42][1]), (60, rows[7][1]), (60, rows[8][1])]       # repeated ids
    assert top(spark, rows, 7, tile_rows=64, block_rows=8) == brute_top(rows, 7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk.search(df.where("vec_id < 0"), lambda i: i % 20 == 0).count() == 0


def top(spark, rows, k, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as band")
    return sorted(map(str, map(tuple, topk.search(df.repartition(3), lambda i: i % 20 == 0, k=k, **more).collect())))


def brute_top(rows, k):
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (q, x) in enumerate(ints):
        if q % 20 == 0:
            best = sorted((-sum(p * r for p, r in zip(x, y)), i) for b, (i, y) in enumerate(ints) if b != a)[:k]
            want += [(q, n + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for n, (s, i) in enumerate(best)]
    return sorted(map(str, want))


def test_topk_keeps_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [9.0, 0.0]), (0, [2.0, 0.0]), (2, [5.0, 1.0])]
    assert top(spark, rows, 4) == brute_top(rows, 4)
    assert "(0, 1, 1, 36864)" in top(spark, rows, 4)


def test_topk_of_huge_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a) for a in rng.normal(size=4) * 10.0 ** rng.integers(-2, 6)]) for i in range(60)]
    rows += [(100, [1e9, 0.0, 3.0, 0.0]), (101, [1e9 + 1, 1.0, 0.0, 0.0]), (102, [-4e16, 1.0, 1.0, 2.0]), (120, [2.5e9, 1e8, 0.0, -7.0])]
    assert top(spark, rows, 5, tile_rows=16, block_rows=2) == brute_top(rows, 5)


# --------------------------------------------------------------------- 5 mixing

def test_mix_meets_the_targets_of_small_sources(spark):
    """Sources of 1, 10 and 33 words (and some more) beside large ones."""
    size = {"a": [1], "b": [3, 7], "c": [33], "d": [20] * 50, "e": [1, 1, 1], "f": [11, 22], "g": [100], "h": [57] * 40}
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate((s, n) for s, ns in size.items() for n in ns)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for s, ns in size.items():
        own = [r for r in out if r.source == s]
        taken, target = sum(r.taken for r in own), own[0].target
        assert abs(taken - target) <= max(0.1 * target, 1), (s, taken, target)
        assert all(r.taken <= 3 * r.size for r in own)
    equal = [(i, "st"[i], "w " * 33) for i in range(2)]
    out = mixing.mix(spark.createDataFrame(equal, "doc_id long, source string, text string"), weights=(1, 2)).collect()
    assert sum(r.taken for r in out) == pytest.approx(66, abs=3)


def test_mix_is_near_its_targets(spark, odd_docs, no_docs):
    big = spark.range(900).selectExpr("id as doc_id", "concat('s', id % 3 * (id % 4)) as source",
                                      "repeat('w ', cast(20 + id % 50 as int)) as text")
    rows = mixing.mix(big).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(big.repartition(7)).collect()))
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 6 * 32
        assert all(r.taken <= 3 * r.size for r in own)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(r.size for r in rows))
    odd = mixing.mix(odd_docs).collect()
    assert sorted(r.size for r in odd) == sorted(len(words(r.text)) for r in odd_docs.collect())
    assert all(r.taken == 0 for r in odd if r.size == 0)
    assert mixing.mix(no_docs).count() == 0


# ------------------------------------------------------------- 6 and 9 tokens

def test_token_counts_equal_the_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BPE)
    counter = token_counts.Counter(BPE)
    odd = ["I'll don't WE'RE", "\n\n \n x ", "a<|endoftext|>b", "x" * 5000, "ab" * 3000 + " 1",
           "٣٤ ²½", "é\U0001f600" * 300, " \u0085\x1c᠎ a 　 b", ""]
    assert [counter.count(t) for t in odd] == [len(lib.encode(t, add_special_tokens=False).ids) for t in odd]
    for r in token_counts.count_tokens(odd_docs, BPE).collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (len(ids), len(ids) > 512, len((r.text or "").encode()))
    assert token_counts.count_tokens(no_docs, BPE).count() == 0


def test_viterbi_by_brute_force_and_round_trip(spark, odd_docs, no_docs):
    coder = pieces.Pieces(MODEL)
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    score = {model.id_to_piece(i): model.get_score(i) for i in range(3, model.vocab_size()) if not model.is_byte(i)}
    longest = max(map(len, score))

    def best(text):
        s = pieces.MARK + text.replace(" ", pieces.MARK)
        top = [0.0] + [-math.inf] * len(s)
        for end in range(1, len(s) + 1):
            for start in range(max(0, end - longest), end):
                if s[start:end] in score:
                    top[end] = max(top[end], top[start] + score[s[start:end]])
            if top[end] == -math.inf:
                top[end] = top[end - 1] + coder.low * len(s[end - 1].encode())
        return top[-1]
    for text in ("Hello  world\n new", " a", "therering é\U0001f600 你好 x", "\n\n", "  "):
        ids, got, _ = coder.encode(text)
        assert got == pytest.approx(best(text)) and coder.decode(ids) == text
    rows = pieces.encode(odd_docs, MODEL)
    assert rows.where("not round_trip").count() == 0
    back = {(r.doc_id, r.text) for r in pieces.decode(rows.select("doc_id", "ids"), MODEL).collect()}
    assert back == {(r.doc_id, (r.text or "").replace(pieces.MARK, " ")) for r in odd_docs.collect()}
    assert pieces.encode(no_docs, MODEL).count() == 0


# -------------------------------------------------------------- 7 classifier

def test_dual_coordinate_descent_separates():
    rows = [np.array([0, 2]), np.array([1, 2]), np.array([0]), np.array([1])]
    w = quality_classifier.descend(rows, [np.ones(len(r)) for r in rows], np.array([1.0, -1.0, 1.0, -1.0]), 3)
    assert w[0] > 0.9 and w[1] < -0.9


def brute_classifier(texts, labels):
    """Log-count ratios of the byte 2- and 3-grams, in plain Python."""
    grams = [sorted({t.encode()[i:i + n] for n in (2, 3) for i in range(len(t.encode()) - n + 1)}) for t in texts]
    names = sorted({g for gs in grams for g in gs})
    pos, neg = (collections.Counter(g for gs, y in zip(grams, labels) if y == want for g in gs) for want in (1, 0))
    p, n = (sum(c[g] + 1 for g in names) for c in (pos, neg))
    ratio = {g: math.log((pos[g] + 1) / p) - math.log((neg[g] + 1) / n) for g in names}
    return grams, ratio


def test_classifier_agrees_with_plain_log_count_ratios(spark, prose):
    """Held-out texts rank as the summed log-count ratios of plain Python do."""
    rows = [(i, prose("aa", 40) if i % 2 else " | ".join(prose("aa", 20).split())) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").where("doc_id < 160")
    model = quality_classifier.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).where("doc_id >= 160").collect()}
    _, ratio = brute_classifier([t for _, t in rows[:160]], [i % 2 for i, _ in rows[:160]])
    for i, t in rows[160:]:
        own = {t.encode()[k:k + n] for n in (2, 3) for k in range(len(t.encode()) - n + 1)}
        assert (sum(ratio.get(g, 0) for g in own) > 0) == (got[i] > 0.5)


def test_classifier_fit_is_bounded_by_its_labels(spark, prose, monkeypatch):
    """One id in very many rows, and labels that contradict each other."""
    seen = []
    monkeypatch.setattr(quality_classifier, "train", lambda samples: seen.append(samples))
    rows = [(1, prose("aa", 20)) for _ in range(400)] + [(i, prose("bb", 20)) for i in range(2, 30)]
    labels = [(1, 1), (1, 0), (1, 1), (2, 0), (2, None), (None, 1), (3, 5)] + [(i, i % 2) for i in range(4, 30)]
    quality_classifier.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                           spark.createDataFrame(labels, "doc_id long, quality int"))
    assert len(seen[0]) <= len(labels) and {y for _, y in seen[0]} == {0, 1}


def test_classifier_learns_and_scores_odd_rows(spark, odd_docs, no_docs, prose):
    docs = spark.createDataFrame([(i, prose("aa", 60) if i % 3 else " | ".join(prose("aa", 40).split()))
                                  for i in range(300)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 > 0 as int) as quality").where("doc_id < 200")
    model = quality_classifier.fit(docs, labels)
    rows = quality_classifier.score(docs, model).where("doc_id >= 200").collect()
    assert all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in rows)
    odd = quality_classifier.score(odd_docs, model)
    assert odd.count() == odd_docs.count() and odd.where("score between 0 and 1").count() == odd.count()
    nothing = quality_classifier.fit(no_docs, labels)
    assert {r.score for r in quality_classifier.score(odd_docs, nothing).collect()} == {0.5}
    assert quality_classifier.score(no_docs, model).count() == 0


# ---------------------------------------------------------------- 8 the join

def brute_components(rows, percent=80):
    sets = []
    for r in rows:
        w = words(r.text)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i].doc_id, rows[j].doc_id) and 100 * len(a & b) >= percent * len(a | b):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    return sorted((str(r.doc_id), len(s), str(None if r.doc_id is None else least[g]))
                  for r, s, g in zip(rows, sets, group))


def joined(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(df).collect())


def test_join_by_brute_force(spark, odd_docs, no_docs):
    assert joined(odd_docs) == brute_components(odd_docs.collect())
    assert jaccard_join.join(no_docs).count() == 0


def test_hot_shingles_are_the_most_frequent(spark, prose):
    rows = [(i, "one common passage that many texts share " + prose("aa", 30)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most in (0, 3, 5, 10_000):
        hot = jaccard_join.hot_shingles(docs, 5, most)
        assert len(hot) <= most + 20 and list(hot) == sorted(set(hot))
    import pyarrow as pa
    shared = set(jaccard_join.shingle_sets(pa.array(["one common passage that many texts share"]), 5)[1].tolist())
    assert len(shared & set(jaccard_join.hot_shingles(docs, 5, 10_000).tolist())) == len(shared)


def test_join_with_the_null_id_first(spark, prose):
    same = prose("aa", 60)
    rows = [(None, same), (1, same), (2, same + " more"), (3, prose("bb", 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert joined(df) == brute_components(df.collect())
    assert dict(r[::2] for r in joined(df))["2"] == "1"


def test_join_of_large_near_groups(spark, prose):
    """More near copies than a shingle hands out as pairs: the tiles' path. A
    chain of edits, each within reach of a few others only."""
    rng = np.random.default_rng(8)
    rows, base = [], prose("aa", 120).split()
    for i in range(90):
        rows.append((i, " ".join(base)))
        base = list(base)
        base[int(rng.integers(len(base)))] = f"edit{i}"
    rows += [(500 + i, " ".join(f"w{k}" for k in range(100 + i))) for i in range(60)]
    rows += [(900 + i, prose("bb", 50)) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df) == brute_components(df.collect())


def test_bitmap_bound_never_prunes_a_link():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n, m = rng.integers(1, 300, 2)
        a = np.unique(rng.integers(0, 400, n).astype(np.uint64))
        b = np.unique(rng.integers(0, 400, m).astype(np.uint64))
        a, b = text_arrays.mix64(a), text_arrays.mix64(b)
        a.sort()
        b.sort()
        d = jaccard_join.differing(jaccard_join.bitmap(a, jaccard_join.width_for(len(a))),
                                   jaccard_join.bitmap(b, jaccard_join.width_for(len(b))))
        assert d <= len(np.setxor1d(a, b))
        for percent in (30, 80):
            over = len(np.intersect1d(a, b))
            is_link = 100 * over >= percent * (len(a) + len(b) - over)
            assert jaccard_join.linked(a, b, percent) == is_link
            assert jaccard_join.may_link(len(a), len(b), d, percent) or not is_link


# ------------------------------------------------------------------- 10 WARC

WARC_DDL = "record_id long, url string, ts long, type string, status int, headers map<string,string>"


def test_canonical_urls(spark):
    cases = {"http://Ex.org:80/a?b=2&a=1#x": "ex.org/a?a=1&b=2", "HTTPS://ex.org": "ex.org/",
             "https://ex.org/?utm_source=q": "ex.org/", "http://ex.org/A": "ex.org/A", None: None}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.c for r in df.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()} == cases


def test_revisits_by_brute_force_with_a_hot_url(spark):
    rng = np.random.default_rng(10)
    rows = []
    for i in range(600):
        url = "http://hot.org/" if i % 3 == 0 else f"http://ex.org/{rng.integers(40)}"
        full = bool(rng.random() < 0.3)
        rows.append((i, url if i % 50 else None, int(rng.integers(80)) if i % 47 else None,
                     "response" if full else "revisit", 200 if full or i % 9 else None,
                     {"ETag": f'"{rng.integers(2)}"', "Date": str(i), "Content-Length": "9"} if i % 11 else None))
    rows += [rows[4], (700, "http://hot.org/", 99, "request", 200, {})]
    got = sorted((r.record_id, r.resolution, r.response_id, sorted((r.headers or {}).items()))
                 for r in warc.resolve(spark.createDataFrame(rows, WARC_DDL)).collect())
    want = []
    for i, url, ts, kind, _, headers in rows:
        if kind != "revisit":
            continue
        own = {k.lower(): v for k, v in (headers or {}).items()}
        before = [(r[2], r[0], r) for r in rows if None not in (url, ts, r[2]) and r[1] == url
                  and r[3] == "response" and r[4] == 200 and (r[2], r[0]) < (ts, i)]
        if not before:
            want.append((i, "missing", None, sorted(own.items())))
            continue
        found = max(before, key=lambda b: b[:2])[2]
        base = {k.lower(): v for k, v in (found[5] or {}).items()}
        if not own or not base:
            want.append((i, "unproven", found[0], sorted(own.items())))
        elif own["etag"] != base["etag"]:
            want.append((i, "conflict", found[0], sorted(own.items())))
        else:
            merged = base | {k: v for k, v in own.items() if k in warc.PERMITTED}
            want.append((i, "resolved", found[0], sorted(merged.items())))
    assert got == sorted(want)
    assert warc.resolve(spark.createDataFrame([], WARC_DDL)).count() == 0


def test_payloads_of_resolved_revisits(spark):
    rows = [(1, "http://a.org/", 1, "response", 200, {"etag": "x"}, "body"),
            (2, "http://a.org/#f", 2, "revisit", 304, {"ETag": "W/x"}, None),
            (3, "http://a.org/", 3, "revisit", 304, {"etag": "y"}, None)]
    df = spark.createDataFrame(rows, WARC_DDL + ", payload string")
    out = warc.with_payload(warc.resolve(df), df)
    assert {r.record_id: (r.status, r.payload) for r in out.collect()} == {2: (200, "body"), 3: (304, None)}


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, scratch_dir):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "encode"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as lang_pred", "2 as row_number")
    docs = docs.union(docs.limit(3))                          # repeated rows
    docs.write.parquet(f"{scratch_dir}/in")
    docs = spark.read.parquet(f"{scratch_dir}/in")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "encode":
            assert out.columns == docs.columns
        out.write.parquet(f"{scratch_dir}/{i}")
        kept = spark.read.parquet(f"{scratch_dir}/{i}")
        if name == "near_duplicates":
            parts = jaccard_join.join(docs).select("component_id").distinct().count()
            assert kept.count() == parts
        if name in ("language", "quality"):
            clean = docs.where("text is not null").join(
                spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
            assert kept.join(clean, "doc_id", "left_semi").count() >= (0.99 if name == "language" else 0.95) * clean.count()
        docs = kept
    assert docs.count() > 0


def test_pipeline_drops_junk_and_keeps_clean_texts(spark):
    """On 1,000 documents (58 of them labelled as junk, eleven of 200 teach too little)."""
    import corpus_pipeline
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ids = lambda df, q: {r.doc_id for r in df.join(labels.where(f"quality = {q}"), "doc_id").collect()}
    kept = corpus_pipeline.quality(spark, docs, sf)
    assert len(ids(kept, 0)) <= 0.15 * len(ids(docs, 0)) and len(ids(kept, 1)) >= 0.97 * len(ids(docs, 1))
    told = corpus_pipeline.language(spark, docs, sf)
    assert told.count() >= 0.99 * docs.where("text is not null").count()


def test_pipeline_keeps_mixed_and_short_clean_texts(spark, prose):
    """Clean texts that switch languages, and short ones: under 1 % go."""
    import corpus_pipeline
    rows = [(i, prose("aa" if i % 2 else "bb", 80), "aa" if i % 2 else "bb") for i in range(200)]
    mixed = [(1000 + i, " ".join(prose(lang, 8) for lang in ("aa", "bb") * 4), None) for i in range(150)]
    short = [(2000 + i, prose("aa" if i % 2 else "bb", 3), None) for i in range(150)]
    odd = [(3000, None, None), (3001, " 12 ", None)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows + mixed + short + odd],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).collect()}
    for part in (rows, mixed, short):
        assert len(kept & {r[0] for r in part}) > 0.99 * len(part)
    assert not kept & {3000, 3001}


def test_pipeline_keeps_the_smallest_id_of_a_group(spark, prose):
    import corpus_pipeline
    same = [prose("aa", 60) for _ in range(4)]
    rows = [(50 - i, same[i % 4]) for i in range(20)] + [(None, same[0]), (None, prose("bb", 40)), (5, prose("bb", 40)), (5, prose("bb", 40))]
    docs = spark.createDataFrame([(i, t, "aa", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [31, 32, 33, 34, None, 5, 5]))


def test_pipeline_stages_on_empty_and_odd_tables(spark, scratch_dir, odd_docs, no_docs):
    import corpus_pipeline
    for k, first in enumerate((no_docs, odd_docs)):
        first.write.parquet(f"{scratch_dir}/odd{k}")
        for name, stage in corpus_pipeline.STAGES:          # each on the same odd rows
            docs = spark.read.parquet(f"{scratch_dir}/odd{k}")
            out = stage(spark, docs, SF)
            n = out.count()
            assert n == 0 if k == 0 else n > 0, name
            if name != "encode":
                assert out.columns == docs.columns


def test_pipeline_row_numbers_survive_a_new_split(spark, scratch_dir, monkeypatch):
    import corpus_pipeline
    rows = [(i, " ".join(f"w{i % 24}x{j}" for j in range(20 + i % 24)), "aa", f"s{i % 3}", 1) for i in range(96)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        16, "doc_id").write.parquet(f"{scratch_dir}/in")
    docs = spark.read.parquet(f"{scratch_dir}/in")
    key, narrow = "spark.sql.files.maxPartitionBytes", corpus_pipeline.narrow

    def split_anew(keys):
        out = narrow(keys)
        spark.conf.set(key, "4m")           # one file a partition from now on
        return out

    steps = (corpus_pipeline.near_duplicates, corpus_pipeline.mix)
    usual = [sorted(map(tuple, step(spark, docs, SF).collect())) for step in steps]
    assert len({r[1] for r in usual[0]}) == len(usual[0]) == 24
    monkeypatch.setattr(corpus_pipeline, "narrow", split_anew)
    for step, want in zip(steps, usual):
        try:
            assert sorted(map(tuple, step(spark, docs, SF).collect())) == want
        finally:
            spark.conf.unset(key)


def test_pipeline_numbers_rows_by_file_and_place(spark, scratch_dir):
    """Numbers are unique and no copy of the texts is written; rows that a scan
    repeats, or that aren't read straight from Parquet, are written with theirs."""
    import corpus_pipeline
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit(1).alias("file_path"))
    docs.repartition(7).write.parquet(f"{scratch_dir}/numbered")
    docs.write.json(f"{scratch_dir}/lines")
    path = f"{scratch_dir}/numbered"
    read = spark.read.parquet(path)
    for frame, by_file in ((read, True), (spark.read.parquet(path, path), False), (read.union(read), False),
                           (read.where("doc_id < 9"), False), (spark.read.json(f"{scratch_dir}/lines"), False),
                           (docs, False)):
        assert (corpus_pipeline._files(frame) is not None) == by_file
        out = corpus_pipeline._numbered(frame, "n")
        assert out.columns == [*frame.columns, "n"]
        assert out.select("n").distinct().count() == out.count() == frame.count()


def test_pipeline_mix_agrees_between_reruns(spark, scratch_dir):
    """The same rows written twice, under other file names: the same mix."""
    import corpus_pipeline
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i % 40)), "aa", f"s{i % 3}", 1) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2)
    got = []
    for k in range(2):
        frame.write.parquet(f"{scratch_dir}/rerun{k}")
        mixed = corpus_pipeline.mix(spark, spark.read.parquet(f"{scratch_dir}/rerun{k}"), SF)
        got.append(sorted(r.doc_id for r in mixed.collect()))
    assert got[0] == got[1]


def test_frequent_shingles_are_counted_over_4_mb_in_less_memory(spark, monkeypatch):
    import pyarrow as pa

    texts = [f"same words in every text here {i} and then {i * 7} some more " * 60 for i in range(700)]
    seen, real = [], jaccard_join.shingle_sets

    def watched(column, n=5):
        seen.append(column.nbytes)
        return real(column, n)

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, ddl):
            self.run = run
            raise StopIteration
    docs = Docs()
    with pytest.raises(StopIteration):
        jaccard_join.hot_shingles(docs, 5, 10)
    monkeypatch.setattr(jaccard_join, "shingle_sets", watched)
    out = list(docs.run([pa.RecordBatch.from_pydict({"text": texts})]))
    assert len(out) == 1 and max(seen) < 600 << 10
    want = collections.Counter(int(h) for h in real(pa.array(texts))[1])
    got = dict(zip((h % 2**64 for h in out[0].column(0).to_pylist()), out[0].column(1).to_pylist()))
    assert got == {h: n for h, n in want.items() if n >= 2}
