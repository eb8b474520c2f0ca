"""Cover-tree codes, chat formatting and importance resampling against brute
force, and on odd rows and empty tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import chat, cover_codes, resampling

VECTORS = "vec_id long, embedding array<double>, label int"


# ------------------------------------------------------- 11 vector codes

def lloyd(rows, parts, entries, rounds, scale=256):
    """Brute force in Python integers: (codes and errors by row, codebooks)."""
    ints = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows]
    width = parts * max(1, -(-max((len(v) for _, _, v in ints), default=0) // parts))
    ints = [(i, label, v + [0] * (width - len(v))) for i, label, v in ints]
    step = width // parts
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * step:(p + 1) * step] for r in first] for p in range(parts)]

    def assign(p):
        out = []
        for _, _, v in ints:
            x = v[p * step:(p + 1) * step]
            d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        for p in range(parts):
            told = assign(p)
            for e in range(len(first)):
                own = [ints[k][2][p * step:(p + 1) * step] for k, (c, _) in enumerate(told) if c == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    told = [assign(p) for p in range(parts)]
    codes = [("".join(f"{told[p][k][0]:02x}" for p in range(parts)), sum(told[p][k][1] for p in range(parts)))
             for k in range(len(ints))]
    return codes, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check_codes(spark, rows, parts, entries, rounds, **more):
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as code", "1 as same", "2 as v", "3 as part")
    got = cover_codes.compress(df.repartition(3), parts=parts, entries=entries, rounds=rounds, **more).collect()
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    codes, digest = lloyd(kept, parts, entries, rounds)
    totals = {}
    for (_, _, label), (_, e) in zip(kept, codes):
        totals[label] = totals.get(label, 0) + e
    fits = lambda v: v if v < 1 << 63 else None
    want = sorted(str((r[0], c, fits(e), fits(totals[r[2]]), digest)) for r, (c, e) in zip(kept, codes))
    assert sorted(str((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in got) == want


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_codes_by_brute_force(spark, spread):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(12, 8))[rng.integers(0, 12, 400)] + spread * rng.normal(size=(400, 8))
    x[30:150] = x[7]                                            # a large group of copies
    rows = [(i, [float(a) for a in v], int(i % 5) if i % 9 else None) for i, v in enumerate(x)]
    check_codes(spark, rows, parts=4, entries=20, rounds=2, tree_rows=97, leaf=4)


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(a) for a in rng.normal(size=5)], i % 3) for i in range(40)]
    rows += [(3, rows[3][1], 1), (3, [0.5], None), (None, rows[5][1], 2), (50, [], 1), (51, None, 1),
             (52, [None] * 5, 1), (53, [math.nan] * 5, 1), (54, [math.inf] + [0.0] * 4, 2)]
    check_codes(spark, rows, parts=4, entries=8, rounds=2)
    check_codes(spark, rows[:3], parts=4, entries=8, rounds=2)      # fewer rows than entries
    huge = rows + [(60, [1e300, -1e12, 3e9, 1.0, 0.0], 0), (-5, [2e9, 2e9, -7.25, 0.0, 1.0], 4)]
    check_codes(spark, huge, parts=4, entries=8, rounds=2, tree_rows=16)
    assert cover_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert cover_codes.compress(spark.createDataFrame([(1, None, None)], VECTORS)).count() == 0


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(13)
    x = np.floor(rng.normal(size=(500, 3)) * 100)
    t = cover_codes.grow(x, leaf=5)
    assert sorted(t["order"]) == list(range(500))
    y = x[t["order"]]
    for i in range(len(t["lo"])):
        own = y[t["lo"][i]:t["hi"][i]]
        assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= t["radius"][i] + 1e-9
        kids = range(t["first"][i], t["last"][i]) if t["first"][i] >= 0 else ()
        assert [t["lo"][k] for k in kids][1:] == [t["hi"][k] for k in kids][:-1]
        centres = np.array([y[t["lo"][k]] for k in kids])
        for a in range(len(centres)):
            assert t["radius"][kids[a]] <= t["radius"][i] / 2 + 1e-9
            for b in range(a):
                assert math.dist(centres[a], centres[b]) > t["radius"][i] / 2
    given = [f for f in cover_codes.walk(t, y, cover_codes.Entries([(0, 0, 0), (90, 90, 90), (-90, 90, 0)])) if len(f) == 3]
    assert sum(int((f[2] - f[1]).sum()) for f in given) > 0     # whole subtrees are given away


# --------------------------------------------------------- 12 chat formatting

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<~s>", "<~~/s>~[~INST]", "<<s>", "[[INST]]", "<image> and <other>", "", None, "é\U0001f600\n<s",
         "[/INST]</s>", "$1 \\ \\n", "a" * 30000 + "</s>"]


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = np.random.default_rng(14)
    bits = ["<", "[", "~", "s>", "/s>", "INST]", "/", "image>", "x", "\n"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 12))) for _ in range(400)] + [t for t in NASTY if t is not None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e")).withColumn("b", chat.unescape(F.col("e"))).collect():
        assert r.b == r.t
        assert not re.search(r"</?s>|\[/?INST\]|<(image|audio|document|other)>", r.e)


def test_chats_read_back(spark):
    rng = np.random.default_rng(15)
    roles = ["user", "assistant", "system", None, "to<s>ol\n"]
    rows = [(int(c), t, roles[int(rng.integers(5))], NASTY[int(rng.integers(len(NASTY) - 1))])
            for c in range(9) for t in range(int(rng.integers(1, 9)))]
    rows += [(77, t, roles[t % 2], f"turn {t} [INST]") for t in range(700)]          # many blocks
    rows += [(None, 1, "assistant", "x"), (5, None, "assistant", "no turn"), (rows[0][0], 0, "user", "again")]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as block", "'f' as fragment", "2 as turns")
    chats = chat.format_chats(df.repartition(5))
    got = {r.conv_id: r for r in chat.digest(chats).collect()}
    whole = {r.conv_id: r.f for r in chats.select("conv_id", chat.formatted(F.col("fragments")).alias("f")).collect()}
    assert set(got) == {r[0] for r in rows}
    escape = lambda s: re.sub(chat.ESCAPE, r"\1~\2", s)
    for c, r in got.items():
        own = sorted(((t is not None, t or 0), role or "", escape(text or ""), text or "") for k, t, role, text in rows if k == c)
        said = "".join(f"{role}\n{text}\n" for _, role, _, text in own)
        loss = "".join(text for _, role, _, text in own if role == "assistant")
        text = "".join(f"<s>{escape(role)}[INST]{e}[/INST]</s>" for _, role, e, _ in own)
        assert whole[c] == text
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(text)
    assert chat.digest(chat.format_chats(df.where("false"))).count() == 0


def test_content_parts(spark):
    part = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
    text = lambda s: ("text", s, None, None, None, None, None)
    rows = [(1, 0, "user", [text("see <image>: "), ("image", None, "a.png", 57, 28, None, None), text(" and "),
                            ("audio", None, "b.wav", None, None, 2.0, None), None]),
            (1, 1, "assistant", [text("ok</s>")]),
            (1, 2, "user", [("document", None, "c.pdf", None, None, None, 3), ("video", None, "d", None, None, None, None),
                            ("image", None, None, None, 28, None, None), text(None)]),
            (2, 0, "user", None), (2, 1, "assistant", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    out = {r.conv_id: r for r in chat.format_chats(df, parts_col="parts").withColumn(
        "text", chat.formatted(F.col("fragments"))).collect()}
    assert out[1].text == ("<s>user[INST]see <~image>: <image> and <audio>[/INST]</s><s>assistant[INST]ok<~/s>[/INST]</s>"
                           "<s>user[INST]<document><other><image>[/INST]</s>")
    assert [tuple(a) for f in out[1].fragments for a in f.attachments] == [
        ("image", "a.png", 4), ("audio", "b.wav", 25), ("document", "c.pdf", 1536), ("other", "d", 0), ("image", None, 0)]
    assert out[1].expanded_tokens == 4 + 25 + 1536
    span = out[1].fragments[0].spans[0]
    assert out[1].fragments[0].text[span.start:span.start + span.length] == "ok<~/s>"
    assert out[2].text == "<s>user[INST][/INST]</s><s>assistant[INST][/INST]</s>"


# ----------------------------------------------------- 13 importance resampling

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_ranks(docs, target, longest=1, buckets=10_000, seed=2024, least=20, percent=10):
    def feats(text):
        w = TOKEN.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1)
                        for i in range(len(w) - n + 1)]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for x in docs:
        np.add.at(s, feats(x[1])[1], 1)
    for x in target:
        np.add.at(t, feats(x)[1], 1)
    g = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        n, f = feats(text)
        weight = sum(g[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(str(tuple(r[:5])) for r in out)


def ranks(df):
    return sorted(str((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in df.collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_ranks_by_brute_force(spark, odd_docs, no_docs, longest):
    target = spark.createDataFrame([("The thering zupf, zupf",), (None,), ("",)], "text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute_ranks(docs, [r.text for r in target.collect()], longest, percent=40)
    for rows in (2, 100):
        got = resampling.resample(odd_docs.repartition(4), target, longest=longest, percent=40, segment_rows=rows, samples=16)
        assert ranks(got) == want
    assert resampling.resample(no_docs, target).count() == 0
    assert resampling.resample(odd_docs, no_docs).count() == odd_docs.count()


def test_ranks_with_a_hot_id(spark, prose):
    """A third of the rows share one id and text, so one score: segments cut
    between them, and no segment is much longer than the others."""
    same = prose("aa", 30)
    docs = [(7, same)] * 300 + [(100 + i, prose("bb" if i % 2 else "aa", 20 + i % 50)) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(prose("bb", 200),)], "text string")
    got = resampling.resample(df, target, percent=50, segment_rows=50, samples=400)
    assert ranks(got) == brute_ranks(docs, [target.first().text], percent=50)
    runs = df.select("doc_id", F.lit(20).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"),
                     F.when(F.col("doc_id") == 7, 5).otherwise(F.col("doc_id")).cast("long").alias("score"),
                     F.monotonically_increasing_id().alias("row")).sortWithinPartitions(F.desc("score"), "doc_id", "row")
    runs = runs.withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    borders = resampling.splitters(runs, 900, 18, 400)
    sizes = [r["count"] for r in resampling.cut(runs.drop("place"), borders).groupBy("segment").count().collect()]
    assert len(sizes) == 18 and max(sizes) <= 100


def test_features_cross_blocks():
    import pyarrow as pa
    rng = np.random.default_rng(16)
    texts = [" ".join("w" * int(rng.integers(1, 60)) + "É" * int(rng.integers(0, 2)) for _ in range(int(rng.integers(0, 40))))
             for _ in range(30)]
    for longest in (1, 2, 4):
        got = {}
        for most in (17, 1 << 20):
            rows = [np.stack(f) for f in resampling.features(pa.array(texts), 997, longest, most)]
            got[most] = sorted(map(tuple, np.concatenate(rows, axis=1).T.tolist()))
        want = []
        for i, text in enumerate(texts):
            w = TOKEN.findall(text.translate(LOWER))
            want += [(i, zlib.crc32(" ".join(w[k:k + n]).encode()) % 997) for n in range(1, longest + 1) for k in range(len(w) - n + 1)]
        assert got[17] == got[1 << 20] == sorted(want)
