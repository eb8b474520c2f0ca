"""Answers kept by prompt hash, files written and packed."""

import json
import os
import time

import pytest

from quire.operators.answers import AnswerStore, send
from quire.sources import files
from quire.sources.packed import PackedFiles, write_files


def logging_fn(log, **rules):
    """A generator that notes every prompt it is sent; ``bad`` prompts fail,
    ``die`` kills the worker when it comes to a prompt."""
    def make(**options):
        def fn(prompts):
            out = []
            for p in prompts:
                if p == rules.get("die") and not os.path.exists(f"{log}.died"):
                    open(f"{log}.died", "w").close()
                    os._exit(1)
                if p in rules.get("bad", ()):
                    raise ValueError("bad prompt")
                with open(log, "a") as f:
                    f.write(p + "\n")
                out.append(f" {p}! " + options.get("tail", ""))
            return out
        return fn
    return make


def sent(log):
    return open(log).read().split() if os.path.exists(log) else []


def prompts(spark, rows):
    return spark.createDataFrame(rows, "id int, prompt string")


def test_no_answered_prompt_is_sent_again(spark, scratch_dir):
    log, store = f"{scratch_dir}/log", AnswerStore(spark, f"{scratch_dir}/store", 4)
    df = prompts(spark, [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "c")])
    first = store.generate(df, "prompt", "text", logging_fn(log), partitions=2)
    assert {r.id: r.text for r in first.collect()} == {1: "a!", 2: "b!", 3: "a!", 4: None, 5: "c!"}
    assert sorted(sent(log)) == ["a", "b", "c"]                                # a prompt of two rows once
    again = store.generate(prompts(spark, [(1, "a"), (9, "d")]), "prompt", "text", logging_fn(log))
    assert {r.id: r.text for r in again.collect()} == {1: "a!", 9: "d!"} and sorted(sent(log)) == ["a", "b", "c", "d"]
    # other options are other prompts
    other = store.generate(prompts(spark, [(1, "a")]), "prompt", "text", logging_fn(log), options={"tail": "x"})
    assert other.first().text == "a! x" and sorted(sent(log)) == ["a", "a", "b", "c", "d"]
    assert store.generate(prompts(spark, []), "prompt", "text", logging_fn(log)).count() == 0


def test_a_killed_run_sends_no_answered_prompt_again(spark, scratch_dir):
    """The worker dies half-way through its task; what it had answered is kept."""
    log, store = f"{scratch_dir}/log", AnswerStore(spark, f"{scratch_dir}/store", 4)
    df = prompts(spark, [(i, f"p{i:02d}") for i in range(30)])
    make = logging_fn(log, die="p17")
    with pytest.raises(Exception):
        store.generate(df, "prompt", "text", make, partitions=1, batch_size=1).collect()
    before = sent(log)
    assert 0 < len(before) < 30 and "p17" not in before
    out = store.generate(df, "prompt", "text", make, partitions=1, batch_size=1)
    assert {r.id: r.text for r in out.collect()} == {i: f"p{i:02d}!" for i in range(30)}
    assert sorted(sent(log)) == [f"p{i:02d}" for i in range(30)]               # each of them once
    assert store.recover() == 0                                               # the spool is empty


def test_a_task_tried_again_reads_its_spool(scratch_dir):
    import pyarrow as pa
    log = f"{scratch_dir}/log"
    batch = pa.RecordBatch.from_pydict({"hash": [f"h{i}" for i in range(6)], "prompt": [f"p{i}" for i in range(6)]})
    args = (f"{scratch_dir}/spool/run/0", logging_fn(log, bad=["p4"]), {}, 2)
    run = send(iter([batch]), *args)
    assert next(run).column(0).to_pylist() == [6]
    assert next(send(iter([batch]), *args)).column(0).to_pylist() == [0]
    assert sent(log) == ["p0", "p1", "p2", "p3", "p5"]
    assert not [f for f in os.listdir(f"{scratch_dir}/spool/run/0") if f.endswith(".writing")]


def test_failed_prompts_are_tried_three_times(spark, scratch_dir):
    log, store = f"{scratch_dir}/log", AnswerStore(spark, f"{scratch_dir}/store", 4)
    calls = f"{scratch_dir}/calls"

    def make():
        def fn(prompts):
            for p in prompts:
                with open(calls, "a") as f:
                    f.write(f"{p} {time.time()}\n")
            if any(p == "bad" for p in prompts):
                raise ValueError("no")
            return [f"ok {p}" for p in prompts]
        return fn
    df = prompts(spark, [(1, "bad"), (2, "good")])
    out = {r.id: r.text for r in store.generate(df, "prompt", "text", make, partitions=1, delay_s=0.5).collect()}
    assert out == {1: None, 2: "ok good"}
    row = store.table.read().where("answer is null").first()
    assert (row.attempts, "no" in row.error) == (3, True) and row.due_ms > 0
    times = [float(x.split()[1]) for x in open(calls) if x.startswith("bad")]
    n = len(times)
    store.generate(df, "prompt", "text", make, partitions=1, delay_s=0.5).collect()       # no fourth time
    assert len([x for x in open(calls) if x.startswith("bad")]) == n
    assert times[-1] - times[0] >= 1.0 and not os.path.exists(log)


# ----------------------------------------------------------------- files

def test_files_are_written_by_tasks(spark, scratch_dir):
    df = spark.createDataFrame([("a.json", "é"), ("b.json", None), ("c.json", "x" * 100)], "name string, body string")
    assert write_files(df.repartition(2), f"{scratch_dir}/f", "name", "body") == 3
    assert sorted(os.listdir(f"{scratch_dir}/f")) == ["a.json", "b.json", "c.json"]
    assert open(f"{scratch_dir}/f/a.json", "rb").read() == "é".encode() and os.path.getsize(f"{scratch_dir}/f/b.json") == 0
    assert write_files(df.where("false"), f"{scratch_dir}/f", "name", "body") == 0
    with pytest.raises(Exception):
        write_files(df.selectExpr("null as name", "body"), f"{scratch_dir}/f", "name", "body")


def test_packed_files_equal_the_files(spark, scratch_dir):
    folder, doc = f"{scratch_dir}/in", lambda i: json.dumps({"texts": [{"text": f" block {i} "}, {"text": "two"}]})
    os.makedirs(folder)
    for i in range(12):
        open(f"{folder}/p{i}.json", "w").write(doc(i))
    open(f"{folder}/bad.json", "w").write("{")
    open(f"{folder}/store.json", "w").write("{}")
    packed = PackedFiles(spark, f"{scratch_dir}/packed", 4)
    v = packed.refresh(folder, "*.json", exclude=["store.json"])

    def same():
        plain = files.read_parsed_documents(spark, folder, exclude=["store.json"]).select("id", "content")
        return sorted(map(str, packed.read_parsed().collect())) == sorted(map(str, plain.collect()))
    assert same() and packed.read().count() == 13
    assert packed.refresh(folder, "*.json", exclude=["store.json"]) == v              # nothing new: no commit
    names = {p.name for p in packed.table.snapshot().parts}
    open(f"{folder}/p3.json", "w").write(doc("changed, and longer"))
    open(f"{folder}/p99.json", "w").write(doc(99))
    assert packed.refresh(folder, "*.json", exclude=["store.json"]) == v + 1 and same()
    assert names & {p.name for p in packed.table.snapshot().parts}                    # other containers stay
    assert packed.read(version=v).count() == 13                                       # and so does the older version
    some = packed.read(["p3", "p5"])
    assert sorted(r.id for r in some.collect()) == ["p3", "p5"]
    assert "In(id" in some._jdf.queryExecution().executedPlan().toString()            # reaches the scan


def odd_folder(root):
    for folder in ("odd", "parts/part=3/q=1", "mixed/k=1"):
        os.makedirs(f"{root}/{folder}")
    for name in ("odd/a b.json", "odd/p%20q.json", "odd/é.json", "odd/_x.json", "odd/.h.json", "odd/_metadata.json", "odd/empty.json",
                 "odd/c.json._COPYING_", "odd/[1].json", "odd/x.pdf", "parts/part=3/q=1/deep.json", "mixed/top.json", "mixed/k=1/below.json"):
        with open(f"{root}/{name}", "w") as f:
            f.write("" if name == "odd/empty.json" else '{"texts":[{"text":"t"}]}')


def test_tasks_list_what_sparks_scan_lists(spark, scratch_dir):
    odd_folder(scratch_dir)
    odd, parts = f"{scratch_dir}/odd", f"{scratch_dir}/parts"
    for folder, glob in [(odd, "*"), (odd, "{x,a b}.*"), (odd, "p%20[a-q].j?on"), (parts, "*"), (f"{scratch_dir}/mixed", "*")]:
        scan = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
        want = sorted(map(tuple, scan.select("path", "length", "modificationTime", "content").collect()))
        got = files.with_bytes(files.listed_files(spark, folder, glob))
        assert sorted(map(tuple, got.select("path", "length", "modified", "content").collect())) == want, (folder, glob)
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(odd).select(
        "_metadata.file_path", "value")
    got = files.read_parsed_documents(spark, odd).select("path", "raw")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, raw.collect()))
    some = spark.createDataFrame([("deep",), ("deep",), (None,)], "id string")
    assert [r.id for r in files.read_binary_documents(spark, parts, "*", only=some).collect()] == ["deep"]
    # what the tasks can't list is left to the scan
    assert [r.id for r in files.list_files(spark, f"{parts}/part=*", "*").collect()] == ["deep"]


def test_many_small_files_are_few_tasks(spark, scratch_dir):
    n = 32 * 16 * 2         # Spark's scan counts 4 MB for opening a file: 32 of them to a task
    df = spark.range(n).selectExpr("concat(id, '.json') as name", "concat('{\"texts\":[{\"text\":\"', id, '\"}]}') as body")
    assert write_files(df, f"{scratch_dir}/f", "name", "body", folders=8) == n
    assert all(d.startswith("part=") for d in os.listdir(f"{scratch_dir}/f"))
    parsed = files.read_parsed_documents(spark, f"{scratch_dir}/f")
    assert parsed.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism < n // 32
    assert {(r.id, r.content) for r in parsed.collect()} == {(str(i), f"{i}\n\n") for i in range(n)}
    assert files.list_files(spark, f"{scratch_dir}/f").count() == n
