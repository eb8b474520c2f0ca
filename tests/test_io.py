"""Sources and sinks in a scratch folder: parsed JSON, binary files,
sections store, keyed dump, documents, catalog tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.sinks import tables
from quire.sources import files


def write(path, text, mode="w"):
    with open(path, mode) as f:
        f.write(text)


def test_read_parsed_documents(spark, scratch_dir):
    write(f"{scratch_dir}/p1.json", json.dumps({"texts": [{"text": " A "}, {"text": "B"}]}))
    write(f"{scratch_dir}/p2.json", json.dumps("bare text"))
    write(f"{scratch_dir}/p3.json", json.dumps({"text": "root"}))
    write(f"{scratch_dir}/sections_store.json", json.dumps({"p1": {}}))
    write(f"{scratch_dir}/notes.txt", "ignored")
    df = files.read_parsed_documents(spark, scratch_dir, exclude=["sections_store.json"])
    got = {r.id: r.content for r in df.collect()}
    assert got == {"p1": "A\n\nB\n\n", "p2": "bare text", "p3": "root"}


def test_binary_listing_and_read(spark, scratch_dir):
    write(f"{scratch_dir}/2401.1v1.pdf", b"%PDF-1.4 one", "wb")
    write(f"{scratch_dir}/x.txt", b"no", "wb")
    listing = files.list_files(spark, scratch_dir, "*.pdf").collect()
    assert [(r.id, r.length) for r in listing] == [("2401.1v1", 12)]
    content = files.read_binary_documents(spark, scratch_dir).first().content
    assert bytes(content) == b"%PDF-1.4 one"


def test_read_sections_missing_is_empty(spark, scratch_dir):
    df = files.read_sections(spark, f"{scratch_dir}/none")
    assert df.count() == 0 and df.schema == schemas.SECTIONS


def test_keyed_json_dump_keeps_nulls_and_unicode(spark, scratch_dir):
    df = spark.createDataFrame([("a", "Ünïcode ✓", None)], "id string, title string, summary string")
    assert tables.dump_keyed_json(df, f"{scratch_dir}/dump")
    lines = spark.read.text(f"{scratch_dir}/dump").collect()
    assert json.loads(lines[0].value) == {"a": {"title": "Ünïcode ✓", "summary": None}}
    assert "Ünïcode ✓" in lines[0].value
    back = files.read_sections_json(spark, f"{scratch_dir}/dump")  # same keyed layout
    assert back.count() == 1
    empty = spark.createDataFrame([], "id string, title string")
    assert not tables.dump_keyed_json(empty, f"{scratch_dir}/empty")
    assert not os.path.exists(f"{scratch_dir}/empty")


def test_write_documents_and_sections(spark, scratch_dir):
    df = spark.createDataFrame([("p1", [{"text": "a"}])], "id string, texts array<map<string,string>>")
    tables.write_documents(df, f"{scratch_dir}/docs")
    assert spark.read.json(f"{scratch_dir}/docs").first().id == "p1"
    s = spark.createDataFrame([("p1", "a", None)], schemas.SECTIONS)
    store = f"{scratch_dir}/sections"
    tables.write_sections(s, store, "w", 1)
    tables.write_sections(s.withColumn("id", F.lit("p2")), store, "w", 2)
    tables.write_sections(s.withColumn("id", F.lit("p2")), store, "w", 2)      # a retry
    assert files.read_sections(spark, store).count() == 2
    assert files.read_sections(spark, store, exclude=("w", 2)).count() == 1
    tables.write_sections(s.withColumn("id", F.lit("p3")), store, "other", 1)  # not the first one's batch 1
    assert files.read_sections(spark, store).count() == 3
    tables.write_sections(s.withColumn("abstract", F.lit("newer")), store, "other", 2)
    assert {r.id: r.abstract for r in files.read_sections(spark, store).collect()} == {
        "p1": "newer", "p2": "a", "p3": "a"}


def test_table_counts_and_orphans(spark):
    spark.range(3).selectExpr("cast(id as string) id").createOrReplaceTempView("tc_docs")
    spark.range(2, 5).selectExpr("cast(id as string) id").createOrReplaceTempView("tc_summ")
    counts = {r["table"]: r.n for r in tables.table_counts(spark, ["tc_docs", "tc_summ"]).collect()}
    assert counts == {"tc_docs": 3, "tc_summ": 3}
    lost = tables.orphans(spark.table("tc_summ"), spark.table("tc_docs"))
    assert sorted(r.id for r in lost.collect()) == ["3", "4"]


def test_conversion_job_twice(spark, scratch_dir):
    import os

    from quire.plans import workflow
    src, out = f"{scratch_dir}/bin", f"{scratch_dir}/converted"
    os.makedirs(src)
    for name, body in (("a", b"one\ntwo"), ("b", b"x"), ("c", b"\xff\xfe")):
        open(f"{src}/{name}.pdf", "wb").write(body)

    def parse(content):
        return [{"text": line} for line in bytes(content).decode("utf-8").split("\n")]
    first = workflow.convert(spark, src, out, parse).first().asDict()
    assert first == {"total": 3, "ok": 2, "failed": 1, "skipped": 0}
    again = workflow.convert(spark, src, out, parse).first().asDict()
    assert again == {"total": 3, "ok": 0, "failed": 1, "skipped": 2}
    got = {r.id: r.content for r in files.read_converted_documents(spark, out).collect()}
    assert got == {"a": "one\n\ntwo\n\n", "b": "x\n\n"}


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from quire.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(
        getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)


def test_catalog_tables_create_clear_replace(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cat1")
    made = tables.create_tables(spark, relevance=True, database="cat1")
    assert set(made) == {"cat1.full_documents", "cat1.summaries"}
    assert tables.create_tables(spark, relevance=True, database="cat1") == []
    docs = "cat1.full_documents"
    assert spark.table(docs).columns == [f.name for f in schemas.RELEVANCE_DOCUMENTS]
    rows = spark.createDataFrame([("a", "T", None, None, None, None, None, None)],
                                 schemas.RELEVANCE_DOCUMENTS)
    rows.write.insertInto(docs)
    # next version computed from the table itself, then switched in
    nxt = spark.table(docs).withColumn("selected", F.lit("yes"))
    tables.replace_table(spark, docs, nxt)
    assert spark.table(docs).first().selected == "yes"
    assert tables.clear_table(spark, docs) == 1
    assert spark.table(docs).count() == 0
    assert tables.clear_table(spark, "cat1.no_such_table") is None


def test_read_papers_prunes_and_pushes(spark, scratch_dir):
    """On a stored table the B5/B6 filters reach the parquet scan and only
    the selected columns are read."""
    from quire.operators import filters
    rows = [("a", "T", "x", "aff", "u", None, None, None),
            ("b", "U", "y", None, "v", None, None, "yes"),
            ("c", "V", "z", None, None, None, None, None)]
    spark.createDataFrame(rows, schemas.RELEVANCE_DOCUMENTS).write.parquet(f"{scratch_dir}/docs")
    df = files.read_papers(spark, f"{scratch_dir}/docs", schema=schemas.RELEVANCE_DOCUMENTS)
    q = filters.pending(filters.with_url(df)).select("id", "pdf_url")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(pdf_url)" in plan and "IsNull(selected)" in plan
    assert "ReadSchema: struct<id:string,pdf_url:string,selected:string>" in plan
    assert [r.id for r in q.collect()] == ["a"]


def test_convert_binary_write_read_extract(spark, scratch_dir):
    """H6 on binary files with a caller's parser → G10 → read back → C3/C4."""
    from quire.functions.sections import with_sections
    from quire.operators.generation import convert_documents
    long = "This sentence is long enough to pass the minimum length gate easily."
    src = f"{scratch_dir}/pdfs"
    os.makedirs(src)
    write(f"{src}/p1.pdf", f"Abstract\n{long}\n1 Intro\nConclusion\n{long}\n".encode(), "wb")
    write(f"{src}/p2.pdf", b"\xff\xfe broken", "wb")
    done = f"{scratch_dir}/done"
    os.makedirs(done)
    write(f"{done}/p3.json", "{}")

    def parse_fn(content: bytes):
        return [{"text": line} for line in bytes(content).decode("utf-8").split("\n")]

    pdfs = files.read_binary_documents(spark, src)
    pdfs = (pdfs.join(files.list_files(spark, done, "*.json").select("id").withColumn("exists", F.lit(True)),
                      "id", "left").fillna(False, ["exists"]))
    out = convert_documents(pdfs, "content", ["id"], parse_fn, skip_col="exists")
    status = {r.id: r.status for r in out.collect()}
    assert status == {"p1": "ok", "p2": "failed"}
    tables.write_documents(out.filter(F.col("status") == "ok"), f"{scratch_dir}/conv")
    docs = files.read_converted_documents(spark, f"{scratch_dir}/conv")
    got = with_sections(docs).first()
    assert (got.id, got.abstract, got.conclusion, got.status) == ("p1", long, long, "ok")


def test_clear_external_table(spark, scratch_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS ext1")
    made = tables.create_tables(spark, database="ext1", location=f"{scratch_dir}/tables")
    assert set(made) == {"ext1.full_documents", "ext1.summaries"}
    spark.createDataFrame([("a", "s")], schemas.SUMMARIES).write.insertInto("ext1.summaries")
    assert tables.clear_table(spark, "ext1.summaries") == 1
    assert spark.table("ext1.summaries").count() == 0


def test_bucketed_tables_join_without_shuffle(spark):
    from quire.operators.joins import summaries_report
    spark.sql("CREATE DATABASE IF NOT EXISTS bkt1")
    spark.catalog.setCurrentDatabase("bkt1")
    tables.create_tables(spark, buckets=4)
    spark.createDataFrame([(str(i), f"T{i}", None, None, None, None) for i in range(40)],
                          schemas.FULL_DOCUMENTS).write.insertInto("full_documents")
    spark.createDataFrame([(str(i), f"S{i}") for i in range(0, 40, 2)],
                          schemas.SUMMARIES).write.insertInto("summaries")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = summaries_report(spark.table("full_documents"), spark.table("summaries"))
        assert report.count() == 20
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        # a new version keeps the bucketing
        nxt = spark.table("summaries").withColumn("summary", F.concat("summary", F.lit("!")))
        tables.replace_table(spark, "summaries", nxt)
        assert spark.table("summaries").filter(F.col("summary").endswith("!")).count() == 20
        desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED summaries").collect()}
        assert desc["Num Buckets"] == "4"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.catalog.setCurrentDatabase("default")
