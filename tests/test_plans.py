"""Scale properties of the executed plans, as regression tests."""

import re

import pytest

from quire.plans import fixtures

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython"]


@pytest.fixture(scope="module")
def plans(query_runs):
    return {name: plan for name, (_, _, plan) in query_runs.items()}


def test_no_pairs_windows_or_row_udfs(plans):
    for name, plan in plans.items():
        for op in FORBIDDEN:
            # the newest rows per search: two bounded merges of the tasks' lists
            assert op not in plan or (name, op) == ("searches_all", "Window"), (name, op)


def test_extraction_is_one_narrow_pass(plans):
    plan = plans["extract_sections"]
    exchanges = re.findall(r"Exchange (\w+)", plan)
    assert exchanges == []
    assert "Join" not in plan and "Aggregate" not in plan


def test_upserts_broadcast_the_batch_not_the_table(plans):
    for name in ["upsert_replace", "upsert_summary"]:
        assert re.search(r"BroadcastHashJoin .*LeftAnti, BuildRight", plans[name]), name
    assert re.search(r"BroadcastHashJoin .*LeftOuter, BuildRight", plans["partial_update"])


def test_date_bounds_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plans["recent_events"])
    assert "Exchange" not in plans["recent_events"]


def test_top_n_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["search_newest"]
    assert "TakeOrderedAndProject" in plans["config_search"]


def test_python_only_in_generation_and_conversion(plans):
    # upsert_summary generates inside its staged batch, so its final plan
    # only reads the staged files
    with_python = {n for n, p in plans.items() if "MapInPandas" in p}
    assert with_python == {"generated_texts", "converted_pages", "converted_lines",
                           "conversion_counters"}


def test_long_ids_stay_apart(spark, scratch_dir):
    ids = [7, 123456, 1000000, 1000003, 1234560, 1234569, 12345678, 1000000000003]
    (spark.createDataFrame([(i, "A line", "en", "s", 6) for i in ids],
                           "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{scratch_dir}/documents.parquet"))
    want = {i: f"2401.{i:06d}v{i % 3 + 1}" for i in ids}
    for make in (fixtures.papers, fixtures.paper_keys):
        assert {r.doc_id: r.paper_id for r in make(spark, scratch_dir).select("doc_id", "paper_id").collect()} == want
    import duckdb

    from quire.plans.oracles import with_papers
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{scratch_dir}/documents.parquet/*.parquet'")
    assert dict(con.sql(with_papers("select doc_id, paper_id from papers")).fetchall()) == want
