"""Operator semantics on hand-written rows, plus plan-shape checks."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import aggregates, filters, generation, joins, upserts

DOC = "id string, title string, authors string, pdf_url string, abstract string, conclusion string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def docs(spark):
    return spark.createDataFrame([
        ("a", "A", "x", "u1", "absA", "conA"),
        ("b", "B", "y", None, None, None),
        ("c", "C", "z", "u3", "absC", None),
    ], DOC)


def test_upsert_replace_last_wins_and_nulls(spark):
    new = spark.createDataFrame([("b", "B1", 1), ("b", "B2", 2), ("d", "D", 1)],
                                "id string, title string, seq int")
    out = upserts.upsert_replace(docs(spark), new, "id", seq="seq")
    assert out.columns == docs(spark).columns
    assert rows(out, "id", "title", "authors", "abstract") == [
        ("a", "A", "x", "absA"), ("b", "B2", None, None), ("c", "C", "z", "absC"),
        ("d", "D", None, None)]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", "s1")], "id string, summary string")
    new = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert rows(upserts.insert_if_absent(old, new), "id", "summary") == [("a", "s1"), ("b", None)]


def test_partial_update_only_non_null_and_known(spark):
    new = spark.createDataFrame([("b", "absB", None), ("c", None, "conC"), ("zz", "x", "y")],
                                "id string, abstract string, conclusion string")
    out = upserts.partial_update(docs(spark), new, ["abstract", "conclusion"])
    assert rows(out, "id", "abstract", "conclusion") == [
        ("a", "absA", "conA"), ("b", "absB", None), ("c", "absC", "conC")]
    check = upserts.verify_update(out, new, ["abstract", "conclusion"])
    assert rows(check, "id", "verified") == [("b", True), ("c", True)]


def test_upsert_summary_keeps_old_on_failure(spark):
    old = spark.createDataFrame([("a", "old"), ("b", "oldb")], "id string, summary string")
    new = spark.createDataFrame([("a", None), ("b", "newb"), ("c", "newc")],
                                "id string, summary string")
    assert rows(upserts.upsert_summary(old, new), "id", "summary") == [
        ("a", "old"), ("b", "newb"), ("c", "newc")]


def test_set_selected(spark):
    t = spark.createDataFrame([("a", None), ("b", "yes"), ("c", None)], "id string, selected string")
    v = spark.createDataFrame([("a", "no"), ("c", "yes")], "id string, selected string")
    assert rows(upserts.set_selected(t, v), "id", "selected") == [
        ("a", "no"), ("b", "yes"), ("c", "yes")]


def test_append_new_idempotent(spark):
    prev = spark.createDataFrame([("a", "x", None)], "id string, abstract string, conclusion string")
    new = spark.createDataFrame([("a", "x2", None), ("b", "y", "z")],
                                "id string, abstract string, conclusion string")
    once = upserts.append_new(prev, new)
    twice = upserts.append_new(once, new)
    assert rows(once, "id", "abstract") == rows(twice, "id", "abstract") == [("a", "x"), ("b", "y")]


def test_dedupe_is_a_partial_aggregate(spark):
    """A hot key is reduced map-side: hash aggregate with a partial step,
    never a window that sorts the whole key in one task."""
    new = spark.range(1000).select(F.lit("hot").alias("id"), F.col("id").alias("seq"),
                                   F.col("id").cast("string").alias("title"))
    plan = upserts.latest_per_key(new, "id", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_max_by" in plan
    assert upserts.latest_per_key(new, "id", "seq").first().title == "999"


def test_semi_anti_and_flag_joins(spark):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    done = spark.createDataFrame([("a",), ("a",), ("a",)], "id string")
    out = joins.unprocessed(todo, done)
    assert rows(out, "id") == [("b",), ("c",)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan        # it would keep a hot key's partition whole
    flagged = joins.match_known(spark.createDataFrame([("a",), ("q",)], "id string"), done)
    assert rows(flagged, "id", "known") == [("a", True), ("q", False)]


def test_summaries_report(spark):
    s = spark.createDataFrame([("c", "sc"), ("a", "sa"), ("b", None), ("z", "sz")],
                              "id string, summary string")
    got = [tuple(r) for r in joins.summaries_report(docs(spark), s).collect()]
    assert got == [("a", "A", "sa"), ("c", "C", "sc")]


def test_selection_stats_null_group(spark):
    t = spark.createDataFrame([("yes",), ("no",), (None,), (None,), ("odd",)], "selected string")
    assert rows(aggregates.selection_stats(t), "label", "n") == [
        ("pending", 1), ("pending", 2), ("rejected", 1), ("selected", 1)]


def test_newest_ties_by_id(spark):
    t = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 3)], "id string, d int")
    got = [r.id for r in filters.newest(t, 3, by="d", tie="id").collect()]
    assert got == ["d", "a", "b"]


def test_by_authors_and_with_url(spark):
    t = spark.createDataFrame([("a", ["X", "Y"], "u"), ("b", ["Z"], None)],
                              "id string, author_names array<string>, pdf_url string")
    assert rows(filters.by_authors(t, ["Y", "Q"]), "id") == [("a",)]
    assert rows(filters.with_url(t), "id") == [("a",)]


def test_generate_custom_fn_and_failures(spark):
    def make_fn():
        def fn(prompts: pd.Series) -> pd.Series:
            if (prompts == "boom").any():
                raise RuntimeError("batch failed")
            return prompts.str.upper() + "  "
        return fn

    df = spark.createDataFrame([("1", "hello"), ("2", None), ("3", "boom"), ("4", "   ")],
                               "id string, prompt string").coalesce(1)
    out = generation.generate(df, "prompt", "g", make_fn)
    assert rows(out, "id", "g") == [("1", "HELLO"), ("2", None), ("3", None), ("4", None)]


def test_generate_passes_options_once_per_task(spark):
    def make_fn(system_prompt=None, model=None):
        def fn(prompts):
            return prompts.map(lambda p: f"{model}|{system_prompt}|{p}")
        return fn

    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, prompt string").coalesce(1)
    out = generation.generate(df, "prompt", "g", make_fn,
                              options={"system_prompt": "be brief", "model": "m1"})
    assert rows(out, "id", "g") == [("1", "m1|be brief|a"), ("2", "m1|be brief|b")]


def test_default_generator_leading_sentences(spark):
    df = spark.createDataFrame([(1, "One. Two!  Three?", "C."), (2, " ", "Only  this\none"), (3, None, "")],
                               "id int, a string, c string")
    got = df.select("id", generation.lead_summary("a", "c").alias("g"))
    assert rows(got, "id", "g") == [(1, "One. Two!"), (2, "Only this one"), (3, None)]


def test_convert_documents_status(spark):
    df = spark.createDataFrame([
        (1, "<html><head><title>T &amp; U</title><script>var x='<p>no</p>'</script></head>"
            "<body><p>Para <b>one</b></p><li>Item</li></body></html>", False),
        (2, None, False), (3, "<p>skip me</p>", True)],
        "page_id long, html string, exists boolean")
    out = generation.convert_documents(df, "html", ["page_id"], skip_col="exists")
    got = {r.page_id: (r.status, r.texts) for r in out.collect()}
    assert got[1][0] == "ok"
    assert [b["text"] for b in got[1][1]] == ["T & U", "Para one", "Item"]
    assert got[2][0] == "failed" and got[3] == ("skipped", None)
    counters = aggregates.conversion_counters(out).first()
    assert (counters.total, counters.ok, counters.failed, counters.skipped) == (3, 1, 1, 1)


def test_row_count_unknown_only_texts_json(spark):
    assert aggregates.row_count(docs(spark)).first().n == 3
    new = spark.createDataFrame([("a",), ("zz",)], "id string")
    assert rows(joins.unknown_only(new, docs(spark)), "id") == [("zz",)]
    assert rows(joins.known_only(new, docs(spark)), "id") == [("a",)]
    t = spark.createDataFrame([([{"text": "x"}],)], "texts array<map<string,string>>")
    assert t.select(generation.texts_to_json().alias("j")).first().j == '{"texts":[{"text":"x"}]}'


def test_stage_and_remove_staged(spark):
    from quire.operators.layout import remove_staged, stage
    staged = stage(spark.range(10).toDF("id"), "housekeeping")
    assert staged.count() == 10
    assert not remove_staged(spark, "another-job")
    assert staged.count() == 10


def test_repeated_and_null_keys(spark):
    t = spark.createDataFrame([("a", "x", "y")], "id string, abstract string, conclusion string")
    new = spark.createDataFrame([("a", 1, "A", None), ("a", 2, None, "C"), ("zz", 1, "q", "q")],
                                "id string, seq int, abstract string, conclusion string")
    out = upserts.partial_update(t, new, ["abstract", "conclusion"], seq="seq")
    assert rows(out, "id", "abstract", "conclusion") == [("a", "A", "C")]
    # without seq the result does not depend on the layout
    many = spark.range(1000).select(F.lit("k").alias("id"), F.col("id").cast("string").alias("title"))
    got = {upserts.latest_per_key(many.repartition(n)).first().title for n in (1, 3, 7)}
    assert got == {"999"}
    bad = spark.createDataFrame([(None, "t"), ("b", "t")], "id string, title string")
    old = spark.createDataFrame([("b", "old")], "id string, title string")
    for job in (upserts.upsert_replace, upserts.insert_if_absent, upserts.append_new):
        with pytest.raises(Exception, match="NULL in key column"):
            job(old, bad).collect()


def test_upsert_with_a_hot_key_holding_a_third_of_the_batch(spark):
    n = 300_000
    batch = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("seq"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"))
    old = spark.createDataFrame([("hot", "old"), ("x", "keep")], "id string, title string")
    out = upserts.upsert_replace(old, batch, "id", seq="seq")
    assert out.count() == 1 + 1 + (n - n // 3)          # x, hot, every cold key
    hot = out.filter(F.col("id") == "hot").collect()
    assert [r.title for r in hot] == [f"t{n - 3}"]        # the last row of the hot key


def test_conversion_goes_by_slices(spark):
    def parse(content):
        if content == "bad":
            raise ValueError("bad")
        # what the task holds at a time: the rows of the batch that it builds
        import sys
        frame = sys._getframe(1)
        n = len(frame.f_locals["pdf"]) if "pdf" in frame.f_locals else frame.f_locals["rows"].num_rows
        return [{"text": content[:5], "n": n, None: None}]
    rows = [(i, None if i == 7 else "bad" if i % 10 == 9 else "x" * (300_000 if i % 100 == 0 else 10)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, body string").coalesce(1)
    out = {r.k: r for r in generation.convert_documents(df, "body", ["k"], parse).collect()}
    assert len(out) == 600 and sum(r.status == "failed" for r in out.values()) == 61 and out[7].texts is None
    ok = [r for r in out.values() if r.status == "ok"]
    assert all(r.texts[0]["text"] == "xxxxx" and r.texts[0]["None"] is None for r in ok)
    assert max(int(r.texts[0]["n"]) for r in ok) <= generation.SLICE_ROWS
