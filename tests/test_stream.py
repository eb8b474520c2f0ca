"""Each parsed file is extracted once; re-runs add nothing; the stream
result equals the batch result."""

import json

from quire.functions.sections import with_sections
from quire.sources.files import read_parsed_documents, read_sections
from quire.streaming.extract_stream import documents_with_sections, extract_stream

LONG = "This sentence is long enough to pass the minimum length gate easily."


def doc(i):
    return json.dumps({"texts": [{"text": "Abstract"}, {"text": f"{LONG} {i}"},
                                 {"text": "1 Introduction"}, {"text": "Conclusion"},
                                 {"text": f"{LONG} end {i}"}, {"text": "References"}]})


def run(spark, src, store, ckpt):
    q = extract_stream(spark, src, store, ckpt, exclude=["sections_store.json"])
    q.awaitTermination(120)
    return read_sections(spark, store)


def test_stream_once_and_equal_to_batch(spark, scratch_dir):
    src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
    import os
    os.makedirs(src)
    for i in range(3):
        open(f"{src}/p{i}.json", "w").write(doc(i))
    open(f"{src}/empty.json", "w").write(json.dumps({"texts": []}))  # no sections: not recorded
    first = run(spark, src, store, ckpt)
    assert sorted(r.id for r in first.collect()) == ["p0", "p1", "p2"]
    again = run(spark, src, store, ckpt)
    assert again.count() == 3
    open(f"{src}/p9.json", "w").write(doc(9))
    third = run(spark, src, store, ckpt)
    assert sorted(r.id for r in third.collect()) == ["p0", "p1", "p2", "p9"]

    batch = with_sections(read_parsed_documents(spark, src), status=None)
    want = {r.id: (r.abstract, r.conclusion) for r in batch.collect() if r.abstract or r.conclusion}
    got = {r.id: (r.abstract, r.conclusion) for r in third.collect()}
    assert got == want

    docs = spark.createDataFrame([("p0", "T", None, None), ("zz", "U", "a", None)],
                                 "id string, title string, abstract string, conclusion string")
    merged = {r.id: r.abstract for r in documents_with_sections(docs, third).collect()}
    assert merged["p0"] == want["p0"][0] and merged["zz"] == "a"


def files_in(src, names):
    import os
    os.makedirs(src, exist_ok=True)
    for n in names:
        open(f"{src}/{n}.json", "w").write(doc(n))


def test_replayed_batch_keeps_its_rows(spark, scratch_dir):
    """A failure after the batch was written but before it was committed."""
    import os
    src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
    files_in(src, ["p0", "p1", "p2"])
    assert run(spark, src, store, ckpt).count() == 3
    for name in os.listdir(f"{ckpt}/commits"):
        os.unlink(f"{ckpt}/commits/{name}")
    assert sorted(r.id for r in run(spark, src, store, ckpt).collect()) == ["p0", "p1", "p2"]


def test_two_streams_share_a_store(spark, scratch_dir):
    store = f"{scratch_dir}/store"
    files_in(f"{scratch_dir}/a", ["p0", "p1"])
    files_in(f"{scratch_dir}/b", ["q0", "p1"])          # p1 again: stored already
    run(spark, f"{scratch_dir}/a", store, f"{scratch_dir}/ckpt-a")
    got = run(spark, f"{scratch_dir}/b", store, f"{scratch_dir}/ckpt-b")
    assert sorted(r.id for r in got.collect()) == ["p0", "p1", "q0"]


def test_reextracted_document_has_one_current_row(spark, scratch_dir):
    from quire.plans import workflow
    from quire import schemas
    src, store = f"{scratch_dir}/conv", f"{scratch_dir}/store"
    files_in(src, ["a"])
    docs = spark.createDataFrame([("a", "T", None, None, None, None)], schemas.FULL_DOCUMENTS)
    workflow.extraction_pass(spark, docs, src, store)
    open(f"{src}/a.json", "w").write(doc("revised"))
    second = workflow.extraction_pass(spark, docs, src, store)     # sections were wiped: extracted again
    assert second.counters.first().previously_processed == 1
    current = read_sections(spark, store)
    assert [r.abstract for r in current.collect()] == [f"{LONG} revised"]
    third = documents_with_sections(docs, current)
    assert third.first().abstract == f"{LONG} revised"


def batches_of(spark, store):
    from quire.sinks.tables import sections_store
    return sections_store(spark, store).snapshot()


def test_copied_file_is_a_document_of_its_own(spark, scratch_dir):
    src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
    files_in(src, ["p0", "p1"])
    run(spark, src, store, ckpt)
    files_in(src, ["p2"])
    files_in(f"{scratch_dir}/again", ["p0"])
    import shutil
    shutil.copy(f"{scratch_dir}/again/p0.json", f"{src}/p0.copy.json")     # its own stem: a new id
    run(spark, src, store, ckpt)
    rows = [r.id for p in batches_of(spark, store).parts
            for r in spark.read.parquet(f"{store}/data/{p.name}").select("id").collect()]
    assert sorted(rows) == ["p0", "p0.copy", "p1", "p2"]


def test_converted_lines_with_repeated_ids(spark, scratch_dir):
    src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
    import os
    os.makedirs(src)

    def lines(name, ids):
        with open(f"{src}/{name}.json", "w") as f:
            for i in ids:
                f.write(json.dumps({"id": i, **json.loads(doc(i))}) + "\n")

    def go():
        q = extract_stream(spark, src, store, ckpt, source="converted")
        q.awaitTermination(120)
    lines("one", ["a", "b", "a"])
    go()
    lines("two", ["b", "c", "a", "c"])
    go()
    go()
    rows = [r.id for p in batches_of(spark, store).parts
            for r in spark.read.parquet(f"{store}/data/{p.name}").select("id").collect()]
    assert sorted(rows) == ["a", "b", "c"]
    assert sorted(r.id for r in read_sections(spark, store).collect()) == ["a", "b", "c"]


def test_no_micro_batch_reads_the_store(spark, scratch_dir):
    """With the stored files made unreadable, the stream goes on."""
    import os
    src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
    files_in(src, ["p0", "p1"])
    run(spark, src, store, ckpt)
    spoiled = 0
    for folder, _, names in os.walk(f"{store}/data"):
        for n in names:
            if n.endswith(".parquet"):
                open(f"{folder}/{n}", "w").write("not parquet")
                spoiled += 1
    assert spoiled
    files_in(src, ["p5"])
    q = extract_stream(spark, src, store, ckpt, exclude=["sections_store.json"])
    q.awaitTermination(120)
    assert q.exception() is None
    last = batches_of(spark, store).parts[-1]
    assert [r.id for r in spark.read.parquet(f"{store}/data/{last.name}").collect()] == ["p5"]


def test_restart_with_state_on_disk(spark, scratch_dir):
    """RocksDB state: a run that fails before its commit starts from the state
    before it, one that fails after it changes nothing."""
    import os
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        src, store, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/store", f"{scratch_dir}/ckpt"
        files_in(src, ["p0", "p1"])
        run(spark, src, store, ckpt)
        files_in(src, ["p2"])
        run(spark, src, store, ckpt)
        first = batches_of(spark, store)
        os.unlink(f"{ckpt}/commits/1")
        if os.path.exists(f"{ckpt}/commits/.1.crc"):
            os.unlink(f"{ckpt}/commits/.1.crc")
        os.unlink(f"{store}/manifests/{first.version:020d}.json")      # never committed to the store
        assert sorted(r.id for r in run(spark, src, store, ckpt).collect()) == ["p0", "p1", "p2"]
        second = batches_of(spark, store)
        assert [(p.writer, p.batch) for p in second.parts] == [(p.writer, p.batch) for p in first.parts]
        os.unlink(f"{ckpt}/commits/1")                                 # committed to the store, then lost
        if os.path.exists(f"{ckpt}/commits/.1.crc"):
            os.unlink(f"{ckpt}/commits/.1.crc")
        assert sorted(r.id for r in run(spark, src, store, ckpt).collect()) == ["p0", "p1", "p2"]
        assert batches_of(spark, store) == second
    finally:
        spark.conf.set(key, before)
