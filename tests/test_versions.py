"""Versioned tables: pinned versions, one winner, merges by bucket, commit order,
compaction."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import upserts
from quire.sinks import tables
from quire.sinks.versions import BUCKET, SEQ, Conflict, VersionedTable, bucket_of, newest_rows
from quire.sources import files

DOCS = "id string, title string, authors string, pdf_url string, abstract string, conclusion string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, a, None) for i, t, a in rows], DOCS)


def table(spark, scratch_dir, buckets=8, n=60):
    t = VersionedTable(spark, f"{scratch_dir}/data/table", schemas.FULL_DOCUMENTS)
    t.create(buckets)
    t.append(docs(spark, [(f"p{i}", f"T{i}", None) for i in range(n)]))
    return t


def titles(df):
    return {r.id: r.title for r in df.collect()}


def test_versions_stay_readable(spark, scratch_dir):
    t = table(spark, scratch_dir)
    assert t.create(3) == 1 and t.snapshot().buckets == 8          # created once
    pinned = t.snapshot()
    t.merge(docs(spark, [("p1", "new", None)]), lambda old, new: upserts.upsert_replace(old, new))
    t.clear()
    assert t.read().count() == 0 and t.read().schema.names == schemas.FULL_DOCUMENTS.names
    assert titles(t.read(pinned))["p1"] == "T1" and titles(t.read(2))["p1"] == "new"
    assert t.read(0).count() == 0
    with pytest.raises(ValueError):
        t.read(99)


def test_one_of_two_writers_wins(spark, scratch_dir):
    t = table(spark, scratch_dir)
    for _ in range(3):
        base, out = t.snapshot(), []

        def write(who, base=base, out=out):
            mine = VersionedTable(spark, t.root, t.schema)
            try:
                out.append((who, mine.replace(docs(spark, [(who, who, None)]), base)))
            except Conflict:
                out.append((who, None))
        workers = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(4)]
        for w in workers:
            w.start()
        for w in workers:
            w.join()
        won = [who for who, version in out if version is not None]
        assert len(out) == 4 and len(won) == 1
        assert titles(t.read()) == {won[0]: won[0]} and t.snapshot().version == base.version + 1
    # what the losers wrote is gone
    assert len(os.listdir(f"{t.root}/data")) == 4


def test_exclusive_create(spark, scratch_dir):
    folder = VersionedTable(spark, scratch_dir, schemas.SUMMARIES).folder
    won = []
    workers = [threading.Thread(target=lambda i=i: won.append(i) if folder.create("m/x.json", str(i)) else None)
               for i in range(8)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert len(won) == 1 and folder.read("m/x.json") == str(won[0])
    assert folder.names("m") == ["x.json"]


def test_merge_keeps_the_files_of_other_buckets(spark, scratch_dir):
    t = table(spark, scratch_dir)
    before = t.snapshot()
    batch = docs(spark, [("p7", "seven", None), ("new", "N", None)])
    touched = {r[0] for r in batch.select(bucket_of("id", 8)).collect()}

    def listing(s):
        return {p.bucket: sorted(n for n in os.listdir(t.path(p)) if n.startswith("part-")) for p in s.parts}
    had = listing(before)
    t.merge(batch, lambda old, new: upserts.upsert_replace(old, new))
    has = listing(t.snapshot())
    assert touched < set(has) and {b: f for b, f in has.items() if b not in touched} == {
        b: f for b, f in had.items() if b not in touched}
    assert all(has[b] != had.get(b) for b in touched)
    got = titles(t.read())
    assert got["p7"] == "seven" and got["new"] == "N" and len(got) == 61
    # only the touched buckets are read
    plan = t.read(buckets=touched)._jdf.queryExecution().optimizedPlan().toString()
    files_read = t.read(buckets=touched).select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split(f"{BUCKET}=")[1].split("/")[0]) for r in files_read} <= touched and plan


def test_merges_of_all_kinds_equal_the_plain_updates(spark, scratch_dir):
    old = docs(spark, [(f"p{i}", f"T{i}", f"A{i}" if i % 2 else None) for i in range(40)])
    new = docs(spark, [(f"p{i}", f"N{i}", f"B{i}" if i % 3 else None) for i in range(30, 50)])
    kinds = {"replace": lambda o, n: upserts.upsert_replace(o, n),
             "insert": lambda o, n: upserts.insert_if_absent(o, n),
             "update": lambda o, n: upserts.partial_update(o, n, ["title", "abstract"])}
    for name, apply in kinds.items():
        t = VersionedTable(spark, f"{scratch_dir}/{name}", schemas.FULL_DOCUMENTS)
        t.create(4)
        t.append(old)
        t.merge(new, apply)
        assert sorted(map(tuple, t.read().collect())) == sorted(map(tuple, apply(old, new).collect()))
    t = VersionedTable(spark, f"{scratch_dir}/empty", schemas.FULL_DOCUMENTS)
    t.create(4)
    t.merge(new, kinds["replace"])                                   # into an empty table
    assert t.read().count() == 20
    t.merge(new.where("false"), kinds["replace"])                    # nothing to merge
    assert t.read().count() == 20
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{scratch_dir}/none", schemas.FULL_DOCUMENTS).merge(new, kinds["replace"])


def test_concurrent_merges_both_land(spark, scratch_dir):
    t = table(spark, scratch_dir)
    errors = []

    def merge(ids, word):
        try:
            VersionedTable(spark, t.root, t.schema).merge(
                docs(spark, [(i, word, None) for i in ids]), lambda old, new: upserts.upsert_replace(old, new))
        except Exception as e:
            errors.append(e)
    ids = [[f"p{i}" for i in range(0, 60, 2)], [f"p{i}" for i in range(1, 60, 2)]]      # the same buckets
    workers = [threading.Thread(target=merge, args=(i, w)) for i, w in zip(ids, ("even", "odd"))]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert not errors
    assert titles(t.read()) == {f"p{i}": "odd" if i % 2 else "even" for i in range(60)}


def sections(spark, rows):
    return spark.createDataFrame(rows, "id string, abstract string, conclusion string")


def test_a_replayed_older_batch_never_wins(spark, scratch_dir):
    store = f"{scratch_dir}/store"
    old, new = sections(spark, [("a", "old", None), ("b", "old", None)]), sections(spark, [("a", "new", "c")])
    tables.write_sections(old, store, "one", 0)
    tables.write_sections(new, store, "two", 0)
    tables.write_sections(old, store, "one", 0)                      # replayed after the newer batch
    want = {"a": "new", "b": "old"}
    assert {r.id: r.abstract for r in files.read_sections(spark, store).collect()} == want
    assert len(tables.sections_store(spark, store).snapshot().parts) == 2
    tables.compact_sections(spark, store)
    tables.write_sections(old, store, "one", 0)                      # and after a compaction
    assert {r.id: r.abstract for r in files.read_sections(spark, store).collect()} == want
    tables.write_sections(sections(spark, [("b", "newest", None)]), store, "one", 1)
    assert {r.id: r.abstract for r in files.read_sections(spark, store).collect()} == {"a": "new", "b": "newest"}


def test_compaction_is_whole_or_nothing(spark, scratch_dir, monkeypatch):
    path = f"{scratch_dir}/store"
    for n in range(4):
        tables.write_sections(sections(spark, [("a", f"v{n}", None), (f"x{n}", "y", None)]), path, "w", n)
    store = tables.sections_store(spark, path)
    want = sorted(map(tuple, files.read_sections(spark, path).collect()))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.compact(newest_rows)
    assert len(store.snapshot().parts) == 4
    assert sorted(map(tuple, files.read_sections(spark, path).collect())) == want
    pinned = store.snapshot()
    store.compact(newest_rows)
    assert len(store.snapshot().parts) == 1
    assert sorted(map(tuple, files.read_sections(spark, path).collect())) == want
    assert store.read(with_seq=True).where(f"id = 'a' and {SEQ} = 3").count() == 1        # rows keep their number
    assert store.read(pinned).count() == 8                           # still there for who pinned it
    # a batch committed while the compaction ran stays beside it
    tables.write_sections(sections(spark, [("a", "later", None)]), path, "w", 4)

    def reduce(rows):
        tables.write_sections(sections(spark, [("a", "last", None)]), path, "w", 5)
        return newest_rows(rows)
    store.compact(reduce)
    assert {r.id: r.abstract for r in files.read_sections(spark, path).collect()}["a"] == "last"
    assert store.vacuum(keep=1) > 0
    assert {r.id: r.abstract for r in files.read_sections(spark, path).collect()}["a"] == "last"
    assert len(store.versions()) == 1


def test_names_of_batches_are_ranges(spark, scratch_dir):
    path = f"{scratch_dir}/store"
    for n in (0, 1, 3, 2, 7):
        tables.write_sections(sections(spark, [("a", str(n), None)]), path, "w", n)
    snapshot = tables.sections_store(spark, path).snapshot()
    assert snapshot.batches == {"w": [[0, 3], [7, 7]]}
    assert snapshot.has("w", 2) and not snapshot.has("w", 4) and not snapshot.has("v", 2)
    assert tables.read_batch(spark, path, "w", 3).first().abstract == "3"
