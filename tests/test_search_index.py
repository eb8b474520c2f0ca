"""The inverted index and the many-search scan against the plain search."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import filters
from quire.operators.many_searches import search_many
from quire.operators.text_index import TextIndex
from quire.plans.search import run_search
from quire.sinks.versions import BUCKET, bucket_of

EXPRESSIONS = [['"ab"'], ['"a b"'], ['"b a b"'], ['"a" AND "c"'], ['("ab" OR "ti c") ANDNOT "b  a"'], ['ti:"a" AND abs:"b"'],
               ['"a\nb"'], ['"É"'], ['"a b" ANDNOT ti:"c"', '"bb b"'], ['"zzz"'], ['"A B"'], ['"  b a "'], ['a b OR c']]
DDL = "id string, title string, content string"


def texts(n, seed=1):
    rng = random.Random(seed)
    bits = ["a", "b", "c", " ", " ", "  ", "\n", "É", "\t", "ti c", "A"]
    text = lambda: None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
    return [(f"p{i}", text(), text()) for i in range(n)]


def ids(df):
    return sorted(r.id for r in df.collect())


def test_index_finds_what_the_scan_finds(spark, scratch_dir):
    docs = spark.createDataFrame(texts(120), DDL)
    index = TextIndex(spark, scratch_dir, ["title", "content"], buckets=4)
    index.add(docs, 0)
    for e in EXPRESSIONS:
        assert ids(index.search(e)) == ids(filters.search_papers(docs, e).select("id")), e
    assert ids(index.search([])) == []


def test_index_grows_by_batches(spark, scratch_dir):
    first, second = texts(60, 2), [(i, "now ab", c) for i, _, c in texts(30, 3)] + [("new", "a b", None)]
    index = TextIndex(spark, scratch_dir, ["title", "content"], buckets=4)
    add = lambda rows, n: index.add(spark.createDataFrame(rows, DDL), n)
    add(first, 0)
    had = {p.name for p in index.postings.snapshot().parts}
    add(second, 1)
    assert had < {p.name for p in index.postings.snapshot().parts}             # nothing was rewritten
    current = spark.createDataFrame(list({r[0]: r for r in first + second}.values()), DDL)

    def same():
        for e in (['"ab"'], ['"a b"'], ['ti:"now"'], ['"b" ANDNOT "a"']):
            assert ids(index.search(e)) == ids(filters.search_papers(current, e).select("id")), e
    same()
    add(first, 0)                                                             # replayed: the newer text stays
    same()
    # a batch that failed between its steps is completed by adding it again
    broken = TextIndex(spark, f"{scratch_dir}/broken", ["title", "content"], buckets=4)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(broken.terms, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            broken.add(current, 0)
    assert ids(broken.search(['"a"'])) == []
    broken.add(current, 0)
    assert ids(broken.search(['"a"'])) == ids(filters.search_papers(current, ['"a"']).select("id"))


def test_search_reads_only_the_buckets_of_its_terms(spark, scratch_dir):
    docs = spark.createDataFrame([(f"p{i}", f"word{i} other{i}", None) for i in range(200)], DDL)
    index = TextIndex(spark, scratch_dir, ["title", "content"], buckets=32)
    index.add(docs, 0)
    found = index.matches([((0,), "word7 other7")])
    read = {f for f in found.inputFiles() if "/postings/" in f}
    terms = spark.createDataFrame([("word7",), ("other7",)], "term string").select(bucket_of("term", 32)).collect()
    want = {r[0] for r in terms}
    # what can start the second word: other7, other70..other79; what can end the first: word7
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in read} >= want
    assert len({f.split(f"{BUCKET}=")[1].split("/")[0] for f in read}) < 20
    assert ids(found.select("id")) == sorted([f"p{i}" for i in range(200) if f"word7 other7" in f"word{i} other{i}"])


def test_many_searches_equal_one_by_one(spark):
    rows = [(i, t, c, None if k % 13 == 0 else f"2024-01-{1 + k % 25:02d} 10:00:00", [f"Author {k % 4}"] if k % 7 else None)
            for k, (i, t, c) in enumerate(texts(150, 5) + texts(20, 6))]
    df = spark.createDataFrame(rows, DDL + ", at string, author_names array<string>").withColumn(
        "submitted_at", F.col("at").cast("timestamp_ntz"))
    searches = {"one": {"keywords": ['"a b"'], "max_results": 5}, "two": {"keywords": EXPRESSIONS[8], "max_results": 40},
                "three": {"keywords": ['"c"'], "authors": ["Author 1", "Author 2"], "max_results": 3},
                "four": {"keywords": ['"a"'], "date_range": {"from": "lastWeek", "to": "today"}, "max_results": 6},
                "all": {"keywords": ['ti:"b"']}, "none": {"keywords": ['"zzz"'], "max_results": 2}}
    got = search_many(df.repartition(5), searches, "2024-01-20").collect()
    for name, spec in searches.items():
        want = [r.id for r in run_search(df, spec, "2024-01-20").collect()]
        own = [r for r in got if r.search == name]
        if "max_results" in spec:
            assert [r.id for r in sorted(own, key=lambda r: r["rank"])] == want, name
            assert sorted(r["rank"] for r in own) == list(range(1, len(want) + 1))
        else:
            assert sorted(r.id for r in own) == sorted(want) and {r["rank"] for r in own} == {None}
    assert search_many(df.where("false"), searches, "2024-01-20").count() == 0
    # one scan, however many searches
    plan = search_many(df, {f"s{i}": searches["one"] for i in range(20)}, "2024-01-20")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_rejected_rows_are_kept_with_their_reason(spark, scratch_dir):
    from quire import schemas
    from quire.sinks.tables import CheckedTable
    docs = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    t = CheckedTable(spark, scratch_dir, schemas.SUMMARIES)
    rows = spark.createDataFrame([("a", "1"), ("x", "2"), (None, "3"), ("b", None)], "id string, summary string")
    t.append(rows, docs, "w", 0)
    t.append(rows, docs, "w", 0)                        # replayed
    assert sorted(map(str, t.accepted.read().collect())) == sorted(map(str, rows.where("id in ('a', 'b')").collect()))
    assert {(r.id, r.summary, r.reason) for r in t.rejected.read().collect()} == {("x", "2", "no parent"), (None, "3", "no key")}
    # a failure between the two commits: the batch is completed, nothing is twice there
    with pytest.MonkeyPatch.context() as m:
        m.setattr(t.accepted, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            t.append(rows, docs, "w", 1)
    t.append(rows, docs, "w", 1)
    assert t.accepted.read().count() == 4 and t.rejected.read().count() == 4


def test_counters_are_taken_while_writing(spark, scratch_dir):
    """E2 and E4 without a second look at what was written: the files are gone
    when the counters are read."""
    import os
    import shutil

    from quire.plans import workflow
    from quire.sinks.tables import write_documents
    blocks = lambda i: [{"text": "Abstract"}, {"text": f"This abstract is long enough to pass the gate of fifty. {i}"},
                        {"text": "1 Introduction"}]
    docs = spark.createDataFrame([("a", blocks(1)), ("b", [{"text": "nothing"}]), ("c", blocks(3)), ("c", blocks(3))],
                                 "id string, texts array<map<string,string>>")
    write_documents(docs, f"{scratch_dir}/in")
    table = spark.createDataFrame([(i, "T", None, None, None, None) for i in "abcd"],
                                  "id string, title string, authors string, pdf_url string, abstract string, conclusion string")
    run = workflow.extraction_pass(spark, table, f"{scratch_dir}/in", f"{scratch_dir}/store", source="converted")
    shutil.rmtree(f"{scratch_dir}/store")
    shutil.rmtree(f"{scratch_dir}/in")
    assert run.counters.first().asDict() == {"total_documents": 4, "json_files": 4, "previously_processed": 0,
                                            "ok": 2, "skipped": 0, "failed": 2}
    assert "Scan parquet" not in run.counters._jdf.queryExecution().executedPlan().toString()
    os.makedirs(f"{scratch_dir}/raw")
    for name in ("x", "y", "z"):
        open(f"{scratch_dir}/raw/{name}.pdf", "w").write(name)

    def parse(content):
        if content == b"y":
            raise ValueError("bad file")
        return [{"text": content.decode()}]
    first = workflow.convert(spark, f"{scratch_dir}/raw", f"{scratch_dir}/out", parse)
    assert tuple(first.first()) == (3, 2, 1, 0)
    assert tuple(workflow.convert(spark, f"{scratch_dir}/raw", f"{scratch_dir}/out", parse).first()) == (3, 0, 1, 2)


def test_index_tasks_follow_the_text(spark, scratch_dir, monkeypatch):
    from quire.operators import text_index

    monkeypatch.setattr(text_index, "TEXT_BYTES", 1000)
    monkeypatch.setattr(text_index, "POSTING_BYTES", 2000)
    docs = spark.createDataFrame([(f"q{i}", "a b", "a b c " * 40) for i in range(60)] + texts(60), DDL)
    index = TextIndex(spark, scratch_dir, ["title", "content"], buckets=2)
    index.add(docs, 0)
    parts = spark.read.parquet(*[index.postings.path(p) for p in index.postings.snapshot().parts])
    sizes = [r["count"] for r in parts.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) > 6 and max(sizes) < parts.count() / 3        # one term's rows are in several files too
    plan = index.matches([((0, 1), "a b"), ((1,), "c")])._jdf.queryExecution().toString()
    assert 1 + index.postings.stored_bytes() // 2000 > 4
    assert "REPARTITION_BY_NUM" in plan
    for e in EXPRESSIONS:
        assert ids(index.search(e)) == ids(filters.search_papers(docs, e).select("id")), e


def test_checked_table_leaves_the_schema_as_it_is(spark, scratch_dir):
    from quire import schemas
    from quire.sinks.tables import CheckedTable

    CheckedTable(spark, scratch_dir, schemas.SUMMARIES, "id")
    assert schemas.SUMMARIES.names == [f.name for f in schemas.SUMMARIES.fields] == ["id", "summary"]


def test_index_shuffles_ids_and_terms_but_no_postings(spark, scratch_dir, monkeypatch):
    dealt, frame = [], type(spark.range(0))
    for name in ("repartitionByRange", "repartition"):
        def seen(self, *a, own=getattr(frame, name)):
            dealt.append(set(self.columns))
            return own(self, *a)
        monkeypatch.setattr(frame, name, seen)
    rows = texts(80, 7)
    index = TextIndex(spark, scratch_dir, ["title", "content"], buckets=4)
    index.add(spark.createDataFrame(rows + [(i, "ﬀ later", c) for i, _, c in rows[:20]], DDL), 0)
    assert not [c for c in dealt if "pos" in c]
    # of rows that repeat an id, the last by its values
    last = {i: (i, t, c) for i, t, c in rows}
    last |= {i: (i, "ﬀ later", c) for i, _, c in rows[:20]}
    current = spark.createDataFrame(list(last.values()), DDL)
    for e in EXPRESSIONS + [['"ﬀ later"']]:
        assert ids(index.search(e)) == ids(filters.search_papers(current, e).select("id")), e
    # postings meet no table of terms, of which there can be as many as new words
    plan = index.matches([((0, 1), "a b"), ((1,), "c")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Join LeftSemi" in plan
    with pytest.raises(Exception, match="NULL in key column"):
        index.add(spark.createDataFrame([(None, "a", "b")], DDL), 1)
