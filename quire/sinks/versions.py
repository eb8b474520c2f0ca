"""Versioned tables: parquet folders named by committed manifests.

A table is a folder with ``data/<part>`` folders, which never change once
written, and ``manifests/<version>.json``. A manifest lists the parts of one
version, so a version is read as it was however much is written meanwhile, and a
job that fails leaves only folders that no manifest names.

A commit puts the next version's manifest in place by one create-if-absent. Of
two writers that start from one version only one can; the other looks at what was
committed and either carries its change over or gives up (``Conflict``).

Parts keep the version that added them, their sequence number: it says which of
two rows of an id was committed later, whatever the clocks of the writers said. A
writer that names its batches commits each one once: a replayed batch finds itself
committed and keeps its first number.

With ``buckets``, every part holds one hash bucket of the key, and a merge
rewrites the buckets that its batch touches and no others.

Manifests are small: one line per part, and ``compact`` makes many parts one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.operators.layout import stage

#: Column names inside the part files.
SEQ, BUCKET = "__seq", "__bucket"


class Conflict(Exception):
    """Another writer committed something that this change can't be carried over."""


@dataclass(frozen=True)
class Part:
    name: str                    # folder below data/
    seq: int                     # the version that added it
    bucket: int | None = None
    writer: str | None = None
    batch: int | None = None


@dataclass(frozen=True)
class Snapshot:
    version: int
    parts: tuple[Part, ...] = ()
    buckets: int | None = None
    #: Batches committed by each named writer, as closed ranges.
    batches: dict[str, list[list[int]]] = field(default_factory=dict)

    def has(self, writer: str, batch: int) -> bool:
        return any(lo <= batch <= hi for lo, hi in self.batches.get(writer, ()))

    def with_batch(self, writer: str, batch: int) -> dict[str, list[list[int]]]:
        spans = sorted([*self.batches.get(writer, ()), [batch, batch]])
        merged = [list(spans[0])]
        for lo, hi in spans[1:]:
            if lo <= merged[-1][1] + 1:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        return {**self.batches, writer: merged}

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "batches": self.batches,
                           "parts": [vars(p) for p in self.parts]})

    @staticmethod
    def of(text: str) -> Snapshot:
        d = json.loads(text)
        return Snapshot(d["version"], tuple(Part(**p) for p in d["parts"]), d["buckets"], d["batches"])


class Folder:
    """Whole small files of one folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, below: str = "") -> list[str]:
        at = self._at(below)
        if not self.fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def size(self, name: str) -> int:
        return self.fs.getContentSummary(self._at(name)).getLength()

    def delete(self, name: str) -> bool:
        return self.fs.delete(self._at(name), True)

    def create(self, name: str, text: str) -> bool:
        """Put a whole file in place unless one is there; False when one is.

        Written beside it first, so nobody sees half a file. On a local file
        system a hard link is the exclusive step, elsewhere a rename that doesn't
        overwrite (one operation of the name node)."""
        self.fs.mkdirs(self._at(name).getParent())
        aside = f"{name}.{uuid.uuid4().hex}.aside"
        out = self.fs.create(self._at(aside), False)
        out.write(text.encode())
        out.close()
        try:
            source, target = self.fs.makeQualified(self._at(aside)), self.fs.makeQualified(self._at(name))
            if source.toUri().getScheme() == "file":
                as_path = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
                self.jvm.java.nio.file.Files.createLink(as_path(target), as_path(source))
            else:
                rename = self.jvm.org.apache.hadoop.fs.Options.Rename
                no_options = self.gateway.new_array(rename, 1)
                no_options[0] = rename.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.conf).rename(
                    source, target, no_options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.delete(aside)


class VersionedTable:
    """A versioned table below ``root``; rows have ``schema`` and a key."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "id"):
        self.spark, self.schema, self.key = spark, schema, key
        self.folder = Folder(spark, root)
        self.root = self.folder.path

    # ------------------------------------------------------------- reading

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names("manifests") if n.endswith(".json")]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version's parts, the newest by default; version -1 is the empty
        table before its first commit."""
        known = self.versions()
        version = max(known, default=-1) if version is None else version
        if version == -1:
            return Snapshot(-1)
        if version not in known:
            raise ValueError(f"no version {version} of {self.root}")
        return Snapshot.of(self.folder.read(f"manifests/{version:020d}.json"))

    def read(self, at: Snapshot | int | None = None, buckets: Iterable[int] | None = None,
             with_seq: bool = False, keep: Callable[[Part], bool] = lambda p: True) -> DataFrame:
        """The rows of a version. ``buckets`` and ``keep`` leave out parts before
        any file is opened; ``with_seq`` adds each row's sequence number."""
        at = at if isinstance(at, Snapshot) else self.snapshot(at)
        wanted = None if buckets is None else set(buckets)
        parts = [p for p in at.parts if (wanted is None or p.bucket in wanted) and keep(p)]
        cols = [F.col(f"`{c}`") for c in self.schema.names]
        stored = StructType([*self.schema.fields, StructField(SEQ, LongType())])
        if not parts:
            return self.spark.createDataFrame([], stored).select(*cols, *([SEQ] if with_seq else []))
        rows = self.spark.read.schema(stored).parquet(*[self.path(p) for p in parts])
        if not with_seq:
            return rows.select(*cols)
        # a part's number, unless its rows carry their own (a compacted part)
        name = F.regexp_extract(F.col("_metadata.file_path"), r".*/data/([0-9a-f]{32}(?:/[^/]+)?)/[^/]+$", 1)
        numbers = self.spark.createDataFrame([(p.name, p.seq) for p in parts], "part string, number long")
        return (rows.withColumn("part", name).join(F.broadcast(numbers), "part")
                .select(*cols, F.coalesce(SEQ, "number").alias(SEQ)))

    def stored_bytes(self, buckets: Iterable[int] | None = None) -> int:
        """Bytes of the newest version's files, or of some buckets' files."""
        wanted = None if buckets is None else set(buckets)
        return sum(self.folder.size(f"data/{p.name}") for p in self.snapshot().parts
                   if wanted is None or p.bucket in wanted)

    def path(self, part: Part) -> str:
        return f"{self.root}/data/{part.name}"

    # ------------------------------------------------------------- writing

    def commit(self, change: Callable[[Snapshot], Snapshot | None], attempts: int = 50) -> int:
        """Commit ``change`` of the newest version and return the new one.

        When another writer is first, the change is made anew on what that one
        committed; a change that can't be carried over raises ``Conflict``. A
        change of None commits nothing."""
        for _ in range(attempts):
            base = self.snapshot()
            new = change(base)
            if new is None:
                return base.version
            new = replace(new, version=base.version + 1)
            if self.folder.create(f"manifests/{new.version:020d}.json", new.to_json()):
                return new.version
        raise Conflict(f"{attempts} other commits came first")

    def create(self, buckets: int | None = None) -> int:
        """The empty first version, unless there is one."""
        return self.commit(lambda base: Snapshot(0, buckets=buckets) if base.version < 0 else None)

    def write(self, df: DataFrame, buckets: int | None, extra: tuple[str, ...] = (),
              spread: bool = True) -> tuple[Part, ...]:
        """Write rows as new parts, which no version names yet. Without ``spread`` the
        tasks that hold the rows sort them and write a file for each of their buckets."""
        name = uuid.uuid4().hex
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields], *extra)
        if not buckets:
            rows.write.parquet(f"{self.root}/data/{name}")
            return (Part(name, -1),)
        # rows of a bucket meet in one task, or in several when there are many; a
        # file's rows are ordered by key, so its statistics lead to a key's row groups
        bucketed = rows.withColumn(BUCKET, bucket_of(self.key, buckets))
        if spread:
            bucketed = bucketed.hint("rebalance", F.col(BUCKET))
        bucketed.sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{name}")
        found = [n for n in self.folder.names(f"data/{name}") if n.startswith(f"{BUCKET}=")]
        return tuple(Part(f"{name}/{n}", -1, int(n.partition("=")[2])) for n in found)

    def discard(self, parts: Iterable[Part]) -> None:
        for top in {p.name.split("/")[0] for p in parts}:
            self.folder.delete(f"data/{top}")

    def append(self, df: DataFrame, writer: str | None = None, batch: int | None = None,
               spread: bool = True) -> int:
        """Add rows. A named writer's batch is added once: replayed, it changes
        nothing and isn't even computed. ``spread`` as for ``write``."""
        named = writer is not None and batch is not None
        now = self.snapshot()
        if named and now.has(writer, batch):
            return now.version
        written = self.write(df, now.buckets, spread=spread)
        mine = {p.name for p in written}

        def add(base: Snapshot) -> Snapshot | None:
            if named and base.has(writer, batch):
                return None
            new = tuple(replace(p, seq=base.version + 1, writer=writer, batch=batch) for p in written)
            return replace(base, parts=base.parts + new,
                           batches=base.with_batch(writer, batch) if named else base.batches)
        version = self.commit(add)
        if not mine & {p.name for p in self.snapshot(version).parts}:
            self.discard(written)
        return version

    def replace(self, df: DataFrame, base: Snapshot) -> int:
        """New content instead of the version ``base``. Of several writers that
        start from one version one commits; the others raise ``Conflict``."""
        written = self.write(df, base.buckets)

        def swap(now: Snapshot) -> Snapshot:
            if now.version != base.version:
                raise Conflict(f"version {now.version} came after {base.version}")
            return replace(now, parts=tuple(replace(p, seq=now.version + 1) for p in written))
        try:
            return self.commit(swap)
        except Conflict:
            self.discard(written)
            raise

    def clear(self) -> int:
        """Delete all rows, keep the schema (G6); earlier versions stay readable."""
        return self.commit(lambda base: replace(base, parts=()))

    def merge(self, batch: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], attempts: int = 10) -> int:
        """Copy-on-write merge (G1-G5): ``apply(old, batch)`` gives the next
        content of the buckets that the batch's keys fall into; the parts of all
        other buckets are carried over as they are. ``apply`` must keep every row
        in its bucket. If another writer changed one of these buckets meanwhile,
        the merge is computed again from what that one committed."""
        n = self.snapshot().buckets
        if not n:
            raise ValueError(f"{self.root} has no buckets")
        batch = stage(batch, "merge")
        touched = {r[0] for r in batch.select(bucket_of(self.key, n)).distinct().collect()}    # at most n rows
        of_touched = lambda s: {p for p in s.parts if p.bucket in touched}
        for _ in range(attempts):
            base = self.snapshot()
            written = self.write(apply(self.read(base, touched), batch), n)
            wrong = {p.bucket for p in written} - touched

            def swap(now: Snapshot) -> Snapshot:
                if of_touched(now) != of_touched(base):
                    raise Conflict("another merge changed the same buckets")
                new = tuple(replace(p, seq=now.version + 1) for p in written)
                return replace(now, parts=tuple(p for p in now.parts if p.bucket not in touched) + new)
            try:
                if wrong:
                    raise ValueError(f"the merge moved rows to buckets {sorted(wrong)} that its batch doesn't touch")
                return self.commit(swap)
            except Conflict:
                self.discard(written)
        raise Conflict(f"{attempts} other merges came first")

    # -------------------------------------------------------- housekeeping

    def compact(self, reduce: Callable[[DataFrame], DataFrame]) -> int:
        """Make the parts of the newest version one. ``reduce`` gets all rows with
        their sequence numbers (``SEQ``) and returns those that stay, with it. Rows
        committed meanwhile stay beside the new part. A crash before the commit
        leaves the table as it is."""
        base = self.snapshot()
        if len(base.parts) < 2:
            return base.version
        written = self.write(reduce(self.read(base, with_seq=True)), base.buckets, extra=(SEQ,))
        old = set(base.parts)

        def swap(now: Snapshot) -> Snapshot:
            if not old <= set(now.parts):
                raise Conflict("the compacted parts were replaced meanwhile")
            later = tuple(p for p in now.parts if p not in old)
            return replace(now, parts=tuple(replace(p, seq=now.version + 1) for p in written) + later)
        try:
            return self.commit(swap)
        except Conflict:
            self.discard(written)
            raise

    def vacuum(self, keep: int = 2) -> int:
        """Forget all versions but the newest ``keep`` and delete the folders that
        only they name. Folders of writers that haven't committed are left alone.
        Returns the number of folders deleted."""
        versions = sorted(self.versions())
        old, kept = versions[:-keep], versions[-keep:]
        tops = lambda vs: {p.name.split("/")[0] for v in vs for p in self.snapshot(v).parts}
        names = lambda vs: {p.name for v in vs for p in self.snapshot(v).parts}
        gone = names(old) - names(kept)
        whole = tops(old) - tops(kept)
        for top in whole:
            self.folder.delete(f"data/{top}")
        single = {n for n in gone if n.split("/")[0] not in whole}
        for name in single:
            self.folder.delete(f"data/{name}")
        for v in old:
            self.folder.delete(f"manifests/{v:020d}.json")
        return len(whole) + len(single)


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def newest_rows(rows: DataFrame, key: str = "id") -> DataFrame:
    """One row per key of rows with ``SEQ``: the one committed last, then the
    largest by its values (two rows of a key in one commit)."""
    others = [c for c in rows.columns if c not in (key, SEQ)]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    best = rows.groupBy(key).agg(F.max(F.struct(F.col(SEQ), row.alias("row"))).alias("s"))
    return best.select(key, *[F.col("s.row")[c].alias(c) for c in others], F.col(f"s.{SEQ}").alias(SEQ))
