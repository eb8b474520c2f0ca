"""Tiles of the near-duplicate join: which classes' sets they need, and their links."""

import random

import pytest

from quire.llm import jaccard_join

DDL = "doc_id long, text string"


def words(rng, n):
    return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]


def staged_rows(monkeypatch):
    """name -> rows of the tables that the join writes."""
    rows, real = {}, jaccard_join.stage

    def counted(df, name="batch"):
        out = real(df, name)
        rows.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(jaccard_join, "stage", counted)
    return rows


def test_texts_that_share_a_passage_need_no_sets(spark, monkeypatch):
    # 120 unlike texts with one passage: its shingles are common, and no list holds them
    rng = random.Random(5)
    passage = words(rng, 45)
    docs = [(i, " ".join(words(rng, 35) + passage + words(rng, 35))) for i in range(120)]
    rows = staged_rows(monkeypatch)
    got = jaccard_join.join(spark.createDataFrame(docs, DDL), hot_list=0).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i in range(120)]
    assert sum(rows["sets"]) == 0           # their bitmaps show that none is like another


def brute(docs, percent=80):
    sets = []
    for _, text in docs:
        w = text.split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    group = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            over = len(a & sets[j])
            if group[i] != group[j] and 100 * over >= percent * (len(a) + len(sets[j]) - over):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [(docs[i][0], docs[g][0]) for i, g in enumerate(group)]


@pytest.mark.parametrize("few, bitmaps, sets", [(2, 1024, 256), (2, 4, 3), (4, 6, 256), (32, 8, 8)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, few, bitmaps, sets):
    # chains of copies, each changed a little from the one before, of very different sizes;
    # a passage in most texts; doc_ids rise along the rows, so a group's first row names it
    rng = random.Random(few * 100 + bitmaps)
    passage, docs = words(rng, 30), []
    for size in (6, 12, 40, 41, 70, 150, 400):
        for _ in range(3):
            text = words(rng, size)
            for _ in range(rng.randrange(1, 9)):
                docs.append((len(docs), " ".join(text if rng.random() < 0.3 else text + passage)))
                text = list(text)
                for _ in range(max(1, size // rng.choice((40, 60, 100)))):
                    text[rng.randrange(len(text))] = f"c{rng.randrange(10 ** 9)}"
    for name, n in (("FEW", few), ("BITMAPS", bitmaps), ("SETS", sets)):
        monkeypatch.setattr(jaccard_join, name, n)
    rows = staged_rows(monkeypatch)
    got = jaccard_join.join(spark.createDataFrame(docs, DDL).repartition(4), hot_list=10).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == brute(docs)
    assert few > 4 or sum(rows.get("near", [0])) > 0      # the tiles had something to find
