"""Extraction pass end to end over files and a table; summarise; judge."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from quire import schemas
from quire.plans import workflow

LONG = "This sentence is long enough to pass the minimum length gate easily."


def test_extraction_pass_counts_and_idempotence(spark, scratch_dir):
    parsed, store = f"{scratch_dir}/conv", f"{scratch_dir}/sections"
    os.makedirs(parsed)
    good = {"texts": [{"text": "Abstract"}, {"text": LONG}, {"text": "1 Intro"}]}
    for pid in ["a", "b"]:
        open(f"{parsed}/{pid}.json", "w").write(json.dumps(good))
    open(f"{parsed}/c.json", "w").write(json.dumps({"texts": [{"text": "nothing"}]}))
    docs = spark.createDataFrame([(i, "T", None, None, None, None) for i in "abcd"],
                                 schemas.FULL_DOCUMENTS)
    run = workflow.extraction_pass(spark, docs, parsed, store)
    c = run.counters.first().asDict()
    assert c == {"total_documents": 4, "json_files": 3, "previously_processed": 0,
                 "ok": 2, "skipped": 0, "failed": 2}
    table = spark.createDataFrame(run.documents.collect(), schemas.FULL_DOCUMENTS)
    assert sorted(r.id for r in table.filter(F.col("abstract").isNotNull()).collect()) == ["a", "b"]

    again = workflow.extraction_pass(spark, table, parsed, store)
    c2 = again.counters.first().asDict()
    assert (c2["ok"], c2["skipped"], c2["failed"], c2["previously_processed"]) == (0, 2, 2, 2)
    assert again.new_sections.count() == 0


def test_summarise_and_judge(spark):
    docs = spark.createDataFrame([
        ("a", "T", "Au", "u", "First. Second. Third.", None),
        ("b", "T", "Au", "u", None, None)], schemas.FULL_DOCUMENTS)
    summaries = spark.createDataFrame([("b", "kept")], schemas.SUMMARIES)
    out = {r.id: r.summary for r in workflow.summarise(docs, summaries).collect()}
    assert out == {"a": "(missing conclusion) First. Second.", "b": "kept"}

    rel = docs.withColumn("affiliation", F.lit("MIT")).withColumn("selected", F.lit(None).cast("string"))

    def make_fn(**_):
        return lambda prompts: pd.Series(['{"is_prestigious": true, "reason": "r"}'] * len(prompts),
                                         index=prompts.index)
    updated, stats = workflow.judge_relevance(rel, make_fn)
    assert sorted(r.selected for r in updated.collect()) == ["yes", "yes"]
    assert [(r.label, r.n) for r in stats.collect()] == [("selected", 2)]


def test_fetch_with_affiliations_and_download_todo(spark):
    import datetime as dt
    catalog = spark.createDataFrame([
        ("2401.00001v2", "World model paper", ["A B", "C D"], "https://x/1", "About world models.",
         dt.datetime(2024, 1, 19, 12), "<entry><affiliation>Uni X</affiliation></entry>"),
        ("2401.00002v1", "Other", ["E F"], None, "Nothing relevant.",
         dt.datetime(2024, 1, 19, 13), "<entry></entry>"),
        ("2401.00003v1", "Old world model", ["G H"], "https://x/3", "world model",
         dt.datetime(2023, 1, 1), "<entry></entry>"),
    ], "id string, title string, author_names array<string>, pdf_url string, summary string, "
       "submitted_at timestamp_ntz, atom_xml string")
    docs = spark.createDataFrame([("2401.00001", "stale", None, None, "u", "old abs", "c", "yes")],
                                 schemas.RELEVANCE_DOCUMENTS)
    summaries = spark.createDataFrame([("2401.00001", "kept")], schemas.SUMMARIES)
    config = {"keywords": ['"world model"'], "date_range": {"from": "lastWeek", "to": "today"},
              "max_results": 5}
    d, s = workflow.fetch_with_affiliations(catalog, docs, summaries, config, "2024-01-20")
    got = {r.id: r for r in d.collect()}
    assert set(got) == {"2401.00001"}
    row = got["2401.00001"]
    assert (row.title, row.authors, row.affiliation, row.abstract, row.conclusion, row.selected) == \
        ("World model paper", "A B, C D", "Uni X", "About world models.", None, None)
    assert {(r.id, r.summary) for r in s.collect()} == {("2401.00001", "kept")}

    listing = spark.createDataFrame([("2401.00001", "/p/2401.00001.pdf", 3)],
                                    "id string, path string, length long")
    more = d.unionByName(spark.createDataFrame(
        [("b", None, None, None, "https://x/b", None, None, None),
         ("c", None, None, None, None, None, None, None)], schemas.RELEVANCE_DOCUMENTS))
    assert [tuple(r) for r in workflow.download_todo(more, listing).collect()] == [("b", "https://x/b")]
