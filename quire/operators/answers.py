"""Generated texts kept by the hash of their prompt (H3), with bounded retries.

A call to a model is the dearest step of the pipeline, so no answered prompt is
sent twice: not for rows that share a prompt, not in a later run, and not by a
task that is tried again. Two places hold answers:

* the answers: a versioned table (``sinks.versions``) in hash buckets, keyed by the
  sha256 of prompt and options, with the number of attempts and, for a failed
  prompt, when it is due again;
* the spool: each task writes a small file per finished batch of prompts, in a
  folder of its own. A task that is tried again reads its folder first and sends
  the rest. What a run leaves there is merged into the answers at its end, or, if
  it was killed, at the start of the next.

The spool lies on the shared folder and is written by the tasks themselves
(``pyarrow.fs``), as Spark would make a task's output visible only at its end.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import upserts
from quire.operators.layout import stage
from quire.sinks.versions import VersionedTable

ANSWERS = T.StructType([T.StructField("hash", T.StringType()), T.StructField("answer", T.StringType()),
                        T.StructField("attempts", T.IntegerType()), T.StructField("due_ms", T.LongType()),
                        T.StructField("error", T.StringType())])
SPOOLED = "hash string, answer string, error string, at_ms long"


def shared_fs(uri: str):
    """(file system, path) of a folder that driver and tasks share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def _finish(text) -> str | None:
    return (text.strip() or None) if isinstance(text, str) else None


def send(batches, folder: str, make_fn, options: dict, batch_size: int):
    """The task: answers prompts in batches of ``batch_size`` and spools each
    batch; yields (number of prompts sent). ``folder`` is this task's own."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    fs, path = shared_fs(folder)
    fs.create_dir(path, recursive=True)
    done = set()
    for f in fs.get_file_info(pafs.FileSelector(path)):
        if f.base_name.endswith(".parquet"):
            done.update(pq.read_table(f.path, filesystem=fs, columns=["hash"]).column(0).to_pylist())
    fn, sent = None, 0
    for batch in batches:
        rows = [(h, p) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if h not in done]
        for at in range(0, len(rows), batch_size):
            some = rows[at:at + batch_size]
            fn = fn or make_fn(**options)
            prompts = pd.Series([p for _, p in some])
            try:
                texts, errors = [_finish(t) for t in fn(prompts)], [None] * len(some)
                if len(texts) != len(some):
                    raise ValueError("the generator returned another number of texts")
            except Exception:                       # one by one, so that one bad prompt spoils no other
                texts, errors = [], []
                for p in prompts:
                    try:
                        texts.append(_finish(list(fn(pd.Series([p])))[0]))
                        errors.append(None)
                    except Exception as e:
                        texts.append(None)
                        errors.append(repr(e)[:500])
            table = pa.table({"hash": [h for h, _ in some], "answer": pa.array(texts, pa.string()),
                              "error": pa.array([e or ("empty" if t is None else None) for t, e in zip(texts, errors)], pa.string()),
                              "at_ms": pa.array([int(time.time() * 1000)] * len(some), pa.int64())})
            name = f"{path}/{uuid.uuid4().hex}"
            pq.write_table(table, f"{name}.writing", filesystem=fs)
            fs.move(f"{name}.writing", f"{name}.parquet")          # whole, or not there
            sent += len(some)
    yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], ["sent"])


class AnswerStore:
    """Answers below ``root`` (a folder that driver and tasks share)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.table = VersionedTable(spark, f"{self.root}/answers", ANSWERS, key="hash")
        self.table.create(buckets)

    @staticmethod
    def hash_of(prompt: str, options: dict):
        return F.sha2(F.concat(F.col(prompt), F.lit("\0" + json.dumps(options, sort_keys=True))), 256)

    def recover(self, delay_s: float = 2.0) -> int:
        """Merge what earlier runs have spooled; returns the number of runs."""
        runs = self.table.folder.names("../spool") if self.table.folder.names("..") else []
        for run in runs:
            self._merge(run, delay_s)
        return len(runs)

    def _merge(self, run: str, delay_s: float) -> None:
        spool = f"{self.root}/spool/{run}"
        tasks = [t for t in self.table.folder.names(f"../spool/{run}")
                 if any(n.endswith(".parquet") for n in self.table.folder.names(f"../spool/{run}/{t}"))]
        if tasks:
            rows = self.spark.read.schema(SPOOLED).option("pathGlobFilter", "*.parquet").parquet(
                *[f"{spool}/{t}" for t in tasks])
            # a prompt is in one task's folder, once: but an answer beats a failure anyway
            new = upserts.latest_per_key(rows.withColumn("order", F.struct(F.col("answer").isNotNull(), "at_ms")), "hash", "order")

            def add(old: DataFrame, new: DataFrame) -> DataFrame:
                had = old.select("hash", F.col("answer").alias("had"), F.col("attempts").alias("before"))
                both = new.join(had, "hash", "left")
                failed = F.col("answer").isNull()
                rows = both.where("had is null").select(
                    "hash", "answer", (F.coalesce("before", F.lit(0)) + 1).cast("int").alias("attempts"),
                    F.when(failed, F.col("at_ms") + F.lit(int(delay_s * 1000))).alias("due_ms"), "error")
                return upserts.upsert_replace(old, rows, "hash")
            self.table.merge(new, add)
        self.table.folder.delete(f"../spool/{run}")

    def generate(self, df: DataFrame, prompt_col: str, out_col: str, make_fn: Callable, options: dict | None = None,
                 partitions: int | None = None, batch_size: int = 16, attempts: int = 3, delay_s: float = 2.0) -> DataFrame:
        """``df`` with ``out_col``, the text of each prompt (``make_fn`` as for
        ``generation.generate``). Prompts without an answer are sent once each; a
        failed one is sent again after ``delay_s`` seconds, ``attempts`` times in
        all, this run or a later one. A NULL prompt isn't sent; NULL is the text
        of a prompt that has none."""
        options = dict(options or {})
        h, p = "__hash", "__prompt"
        keyed = df.withColumn(h, self.hash_of(prompt_col, options))
        prompts = stage(keyed.where(F.col(h).isNotNull()).groupBy(F.col(h).alias("hash")).agg(
            F.min(prompt_col).alias(p)), "prompts")
        self.recover(delay_s)
        for _ in range(attempts):
            known = self.table.read().select("hash", "answer", "attempts", "due_ms")
            state = prompts.join(known, "hash", "left").where(F.col("answer").isNull() & (
                F.coalesce("attempts", F.lit(0)) < attempts))
            todo = stage(state.select("hash", p, "due_ms"), "todo")
            wait = todo.agg(F.max("due_ms").alias("due"), F.count(F.lit(1)).alias("n")).first()
            if not wait["n"]:
                break
            if wait["due"]:
                time.sleep(min(max(0.0, wait["due"] / 1000 - time.time()), delay_s))
            self._send(todo.select("hash", p), make_fn, options, partitions, batch_size, delay_s)
        answers = self.table.read().select(F.col("hash").alias(h), F.col("answer").alias(out_col))
        return keyed.join(answers, h, "left").drop(h)

    def _send(self, todo: DataFrame, make_fn, options, partitions, batch_size, delay_s) -> None:
        run = uuid.uuid4().hex
        spool = f"{self.root}/spool/{run}"
        n = partitions or todo.rdd.getNumPartitions()

        def task(batches):
            from pyspark import TaskContext

            # the same rows in every attempt: they are dealt by their hash
            yield from send(batches, f"{spool}/{TaskContext.get().partitionId()}", make_fn, options, batch_size)

        todo.repartition(n, "hash").mapInArrow(task, "sent long").agg(F.sum("sent")).collect()
        self._merge(run, delay_s)
