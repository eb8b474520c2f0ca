"""Exact n-gram Jaccard self-join by size-banded tiles with bitmap signatures.

A document's set is its distinct five-word shingles (64-bit hashes; fewer than
five words make one shingle; words in lower case A-Z). Documents with equal
sets form one class, named by a hash of the set, and classes are joined:

1. Candidates. Two sets that reach the threshold share a shingle among the
   first n - ceil(t * n) + 1 of each in any common order. The order puts the
   most frequent shingles last, so passages that many documents share seldom
   make candidates. Any order is right, so the list of frequent ones may be
   bounded (``hot_list``).
2. A shingle shared by few classes gives its pairs of fitting size directly. In
   one shared by many, each class makes a pair with the least one.
3. Each set has a hashed bitmap of parities. The bits in which two bitmaps
   differ are at most the elements in which the sets differ, which bounds the
   overlap from above; what passes is verified by an exact intersection of
   sorted arrays.
4. The classes of a shared shingle are cut into tiles: bands of sizes (only equal
   or neighbouring bands can link) and, within a band, bounded blocks. A tile
   compares bitmaps, not sets, of classes that aren't yet connected. Few pass, as
   most shingles that many share are passages in texts of their own; classes that
   pass make clusters, in whose tiles the sets are compared. Pairs that are already
   connected are skipped. No group of copies meets in one task.
5. Links make components (``common.components``).

Defined cases: a document without words has no set, size 0, and is its own
component; a null id gets a null component and links nothing; rows that repeat
an id are separate rows; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import text_arrays as ta
from quire.llm.common import components, lean, narrow, stage

#: A shingle in the prefixes of more classes than this is handled by tiles.
FEW = 32
#: Classes of a block whose bitmaps, or whose sets, a tile compares.
BITMAPS, SETS = 1024, 256
_STEP = ta.randoms(64, 3)
_BIT = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, ordered by both."""
    w = ta.words(column)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = len(w.start)
    count = np.bincount(w.doc, minlength=len(column))
    if total >= n:
        full = w.doc[n - 1:] == w.doc[:total - n + 1]
        h = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            h += w.hash[k:total - n + 1 + k] * _STEP[k]
        doc, h = w.doc[:total - n + 1][full], ta.mix64(h[full])
    else:
        doc, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = count[w.doc] < n
    if short.any():      # one shingle for all words of a short text
        d = w.doc[short]
        first = np.append(True, d[1:] != d[:-1])
        at = np.flatnonzero(first)
        place = np.arange(len(d)) - np.repeat(at, np.diff(np.append(at, len(d))))
        whole = np.add.reduceat(w.hash[short] * _STEP[place + 8], at) + count[d[at]].astype(np.uint64)
        doc, h = np.append(doc, d[at]), np.append(h, ta.mix64(whole))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])) if len(doc) else np.zeros(0, bool)
    return doc[new], h[new]


def needed(n, percent: int):
    """ceil(percent * n / 100)."""
    return (percent * n + 99) // 100


def set_name(h: np.ndarray) -> int:
    """64-bit name of a set, for any order of its elements."""
    s = np.add.reduce(ta.mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + np.uint64(len(h))
    return int(ta.mix64(np.array([s], np.uint64)).view(np.int64)[0])


def bitmap(h: np.ndarray, width: int) -> np.ndarray:
    """Parity of the elements hashed to each of ``width`` bits (a power of
    two, 64 at least), as 64-bit words. Folding it in half by exclusive or gives
    the bitmap of half the width."""
    bit = ((h * _BIT) >> np.uint64(20)) & np.uint64(width - 1)
    odd = np.bincount(bit.astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def width_for(n: int) -> int:
    return max(64, 1 << int(2 * n - 1).bit_length())


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Bits in which two bitmaps differ, folded to the narrower width."""
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def may_link(n, m, differ, percent: int):
    """Whether the bound (n + m - differ) / 2 on the overlap allows a link."""
    over = (n + m - differ) // 2
    return 100 * over >= percent * (n + m - over)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted arrays of distinct elements."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    over = int((b[at] == a).sum())
    return 100 * over >= percent * (len(a) + len(b) - over)


def hot_shingles(docs: DataFrame, n: int, most: int) -> np.ndarray:
    """About ``most`` shingles of largest count (counts below 2 in 4 MB of text are
    left out), sorted. A histogram of the counts, in steps of an eighth of a
    doubling, gives the steps that fit whole; of the next one, a share by hash. So
    the driver gets no more rows than these (and a few by chance)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, "text", 4 << 20):
                # the arrays of words and places are some 40 times the text: built for less of it
                sets = [shingle_sets(few.column(0), n)[1] for few in ta.slices(part, "text", ta.FEW_BYTES)]
                h, count = np.unique(np.concatenate(sets), return_counts=True)
                some = count >= 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[some].view(np.int64)), pa.array(count[some])], ["h", "n"])

    step = F.floor(F.log2("n") * 8).cast("int")
    counts = docs.select("text").mapInArrow(lean(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = stage(counts.withColumn("step", step), "counts")
    reached, share = 0, F.lit(False)
    for r in sorted(counts.groupBy("step").count().collect(), reverse=True):       # at most 504 rows
        part = min(1.0, (most - reached) / r["count"])
        inside = F.lit(True) if part == 1 else F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < int(part * (1 << 20))
        share = share | ((F.col("step") == r["step"]) & inside)
        reached += r["count"]
        if reached >= most:
            break
    top = counts.where(share).select("h").toArrow()     # as rows they would be some 100 bytes each, twice
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def described(docs: DataFrame, n: int, percent: int, hot: np.ndarray) -> DataFrame:
    """(doc_id, n, class, prefix, bits) of every row; one without an id has no
    class. A task writes prefix and bits only for the first row that it sees of
    a class."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)   # bounded by hot_list
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        seen = set()
        for batch in batches:
            for part in ta.slices(batch, "text", ta.FEW_BYTES):
                doc, h = shingle_sets(part.column(1), n)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                size, name, prefix, bits = np.diff(cut), [], [], []
                hot_list = shared.value
                where = np.searchsorted(hot_list, h)
                where[where == len(hot_list)] = 0
                is_hot = hot_list[where] == h if len(hot_list) else np.zeros(len(h), bool)
                no_id = part.column(0).is_null().to_numpy(zero_copy_only=False)
                for null, a, b in zip(no_id, cut, cut[1:]):
                    if null or a == b:          # links nothing
                        name.append(None)
                        prefix.append(None)
                        bits.append(None)
                        continue
                    own = h[a:b]
                    c = set_name(own)
                    name.append(c)
                    if c in seen:
                        prefix.append(None)
                        bits.append(None)
                        continue
                    seen.add(c)
                    p = (b - a) - needed(b - a, percent) + 1
                    rare = own[~is_hot[a:b]]
                    first = rare[:p] if len(rare) >= p else np.concatenate([rare, own[is_hot[a:b]][:p - len(rare)]])
                    prefix.append(first.view(np.int64))
                    bits.append(bitmap(own, width_for(b - a)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(name, pa.int64()),
                     pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                    ["doc_id", "n", "class", "prefix", "bits"])

    return docs.select("doc_id", "text").mapInArrow(
        lean(run), f"doc_id {id_type}, n long, class long, prefix array<long>, bits binary")


def _runs(percent: int):
    """Rows (token, n, class), ordered by all three, to light pairs (kind 0: a,
    b) and members of heavy shingles (kind 1: a the class, b the shingle)."""
    def run(batches):
        import pyarrow as pa

        def out(kind, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"])
        none = np.zeros(0, np.int64)
        held, heavy = (none, none, none), None     # the last run, and a heavy shingle that goes on

        def finish(t, n, c):
            if not len(t):
                return
            keep = np.append(True, (t[1:] != t[:-1]) | (c[1:] != c[:-1]))   # rows of one class agree in n
            t, n, c = t[keep], n[keep], c[keep]
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            length = np.repeat(np.diff(np.append(first, len(t))), np.diff(np.append(first, len(t))))
            many = length > FEW
            if many.any():
                yield out(1, c[many], t[many])
            t, n, c = t[(length > 1) & ~many], n[(length > 1) & ~many], c[(length > 1) & ~many]
            a, b = [], []
            for step in range(1, FEW):
                ok = (t[step:] == t[:-step]) & (100 * n[:-step] >= percent * n[step:])
                a.append(np.minimum(c[:-step][ok], c[step:][ok]))
                b.append(np.maximum(c[:-step][ok], c[step:][ok]))
            pair = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            if len(pair):
                yield out(0, pair[:, 0].copy(), pair[:, 1].copy())

        for batch in batches:
            t, n, c = (np.asarray(batch.column(i)) for i in range(3))
            if heavy is not None:
                k = int(np.searchsorted(t != heavy, True)) if len(t) else 0
                if k:
                    yield out(1, c[:k], t[:k])
                t, n, c = t[k:], n[k:], c[k:]
                if len(t):
                    heavy = None
            t, n, c = (np.concatenate([x, y]) for x, y in zip(held, (t, n, c)))
            if not len(t):
                held = (none, none, none)
                continue
            last = len(t) - int(np.searchsorted((t != t[-1])[::-1], True))
            yield from finish(t[:last], n[:last], c[:last])
            held = (t[last:], n[last:], c[last:])
            if len(np.unique(held[2])) > FEW:
                heavy = held[0][0]
                yield out(1, held[2], held[0])
                held = (none, none, none)
        yield from finish(*held)
    return run


def _tile_links(percent: int):
    """Links between two tiles of sets, enough to connect what they connect
    beyond the groups that are connected before."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = np.concatenate([left["l_class"].to_numpy(), right["r_class"].to_numpy()])
        groups = np.concatenate([left["l_group"].to_numpy(), right["r_group"].to_numpy()])
        blobs = [*left["l_set"], *right["r_set"]]
        names, at = np.unique(names, return_index=True)
        sets = [np.frombuffer(blobs[i], np.uint64) for i in at]
        side = at < len(left)                      # a tile with itself: all are left
        other = np.isin(names, right["r_class"].to_numpy())
        size = np.array([len(s) for s in sets], np.int64)
        width = width_for(int(size.max()) if len(size) else 1)
        bits = np.stack([bitmap(s, width) for s in sets]) if sets else np.zeros((0, 1), np.uint64)
        group = groups[at]
        a, b = [], []
        order = np.argsort(size, kind="stable")
        for k, i in enumerate(order):
            rest = order[k + 1:]
            rest = rest[100 * size[i] >= percent * size[rest]]
            rest = rest[(group[rest] != group[i]) & ((side[rest] & other[i]) | (other[rest] & side[i]))]
            if not len(rest):
                continue
            differ = np.bitwise_count(bits[rest] ^ bits[i]).sum(1).astype(np.int64)
            for j in rest[may_link(size[i], size[rest], differ, percent)]:
                if group[j] != group[i] and linked(sets[i], sets[j], percent):
                    a.append(names[i])
                    b.append(names[j])
                    group[group == group[j]] = group[i]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def _near(percent: int):
    """Rows (tile, side, n, class, group, bits), ordered by tile, to (a, b) that
    connect, tile by tile, all classes with a pair across groups whose bitmaps allow
    a link. ``side`` has bit 1 for the left and bit 2 for the right."""
    def compared(side, n, name, group, bits):
        order = np.argsort(n, kind="stable")
        side, n, name, group = side[order], n[order], name[order], group[order]
        # as many words as half the widest bitmap that its own size needs, row by row
        whole = [np.frombuffer(bits[i], np.uint64) for i in order]
        width = np.array([len(w) for w in whole])
        parts, place = {}, np.zeros(len(n), np.int64)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            full = np.stack([whole[i] for i in rows])
            parts[w] = rows[0], full, full[:, :w // 2] ^ full[:, w // 2:] if w > 1 else full
            place[rows] = np.arange(len(rows))
        last = np.searchsorted(n, 100 * n // percent, "right")     # sizes beyond are too large
        label, found = np.arange(len(n)), np.zeros(len(n), bool)
        for i in range(len(n) - 1):
            differ = []
            for w, halved in ((width[i], False), (2 * width[i], True)):
                if w in parts:
                    start, full, half = parts[w]
                    lo, hi = max(i + 1, start) - start, min(last[i], start + len(full)) - start
                    if lo < hi:
                        own = parts[width[i]][1][place[i]]
                        differ.append(np.bitwise_count((half if halved else full)[lo:hi] ^ own).sum(1))
            if not differ:
                continue
            differ = np.concatenate(differ).astype(np.int64)
            rest = slice(i + 1, i + 1 + len(differ))
            ok = (group[rest] != group[i]) & may_link(n[i], n[rest], differ, percent)
            ok &= ((side[rest] & 2 > 0) & (side[i] & 1 > 0)) | ((side[rest] & 1 > 0) & (side[i] & 2 > 0))
            if ok.any():
                hits = np.append(np.flatnonzero(ok) + i + 1, i)
                found[hits] = True
                label[np.isin(label, label[hits])] = label[hits].min()
        return name[found], name[label[found]]

    def run(batches):
        import pyarrow as pa

        held = None                 # the rows of the last tile: two blocks at most
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            tile = table.column(0).to_numpy()
            first = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])), len(tile))
            a, b = [], []
            for lo, hi in zip(first[:-2], first[1:-1]):
                x, y = compared(*(table.column(k).slice(lo, hi - lo).to_numpy() for k in range(1, 6)))
                a.append(x)
                b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            held = pa.Table.from_batches(table.slice(first[-2]).to_batches()).combine_chunks().to_batches()[0]
        if held is not None:
            x, y = compared(*(held.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6)))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
    return run


def tiles(member: DataFrame, of: str, most: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows of ``member`` with band and block, tile): every pair of equal or
    neighbouring bands of sizes of one ``of``, cut into blocks of some ``most``."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("long")
    member = member.withColumn("band", band)
    blocks = member.groupBy(of, "band").agg(F.ceil(F.count("*") / most).alias("blocks"))
    member = member.join(blocks, [of, "band"]).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks"))).drop("blocks")
    up = blocks.select(of, (F.col("band") - 1).alias("band"), F.col("blocks").alias("up_blocks"))
    # bands are as wide as the size filter, so sizes two bands apart never link
    own = blocks.select(of, "band", F.col("band").alias("band2"), "blocks", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).select(
        of, "band", "block", "band2", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block2"))
    next_up = blocks.join(up, [of, "band"]).select(
        of, "band", (F.col("band") + 1).alias("band2"), "up_blocks", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).select(
        of, "band", "block", "band2", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("up_blocks") - 1)).alias("block2"))
    return member, own.unionByName(next_up)


def near_classes(heavy: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) that connect the classes of ``heavy(class, token)`` with a pair that
    shares a token, isn't in one group and whose bitmaps allow a link."""
    meet = heavy.join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))
    mixed = meet.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi"),
                                      F.count("*").alias("k")).where("lo <> hi").select("token", "k")
    meet = stage(meet.join(mixed, "token").join(classes.select("class", "n"), "class"), "meetings")
    bits = classes.select("class", "bits")
    columns = ["tile", "side", "n", "class", "group"]
    small = meet.where(F.col("k") <= BITMAPS).select(
        F.xxhash64("token").alias("tile"), F.lit(3).alias("side"), "n", "class", "group")
    member, tile = tiles(meet.where(F.col("k") > BITMAPS).drop("k"), "token", BITMAPS, percent)
    member, tile = stage(member, "many"), stage(tile, "tiles")
    key = F.xxhash64("token", "band", "block", "band2", "block2").alias("tile")
    same = F.when(F.expr("band = band2 and block = block2"), 3)
    lefts = member.join(tile, ["token", "band", "block"]).select(
        key, F.coalesce(same, F.lit(1)).alias("side"), "n", "class", "group")
    rights = (member.withColumnsRenamed({"band": "band2", "block": "block2"})
              .join(tile.where("band <> band2 or block <> block2"), ["token", "band2", "block2"])
              .select(key, F.lit(2).alias("side"), "n", "class", "group"))
    rows = small.unionByName(lefts).unionByName(rights).join(bits, "class").select(*columns, "bits")
    rows = rows.repartition("tile").sortWithinPartitions("tile")
    return stage(rows.mapInArrow(lean(_near(percent)), "a long, b long"), "near")


def links(docs: DataFrame, about: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links between classes, classes): links(a, b) connect what the join
    connects; classes(class, n, rep) has the smallest id of each class."""
    known = about.where("class is not null and doc_id is not null")
    classes = stage(known.groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"),
        F.first("bits", ignorenulls=True).alias("bits")), "classes")
    tokens = (about.where("prefix is not null").select(F.explode("prefix").alias("token"), "n", "class")
              .repartition("token").sortWithinPartitions("token", "n", "class"))
    found = stage(tokens.mapInArrow(lean(_runs(percent)), "kind int, a long, b long"), "candidates")

    def passing(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pydict()
            ok = [may_link(x, y, differing(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)), percent)
                  for x, y, p, q in zip(rows["n"], rows["m"], rows["p"], rows["q"])]
            keep = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(keep)) for i in (0, 1)], ["a", "b"])

    # a shingle that many share also gives the pairs with its least class: those that
    # share several with one class are often its copies, and are connected before any tile
    heavy = stage(found.where("kind = 1").select(F.col("a").alias("class"), F.col("b").alias("token")).distinct(),
                  "heavy")
    least = heavy.groupBy("token").agg(F.min("class").alias("a"))
    stars = (heavy.join(least, "token").where("class <> a").groupBy("a", F.col("class").alias("b"))
             .count().where("count > 1").select("a", "b"))
    left = classes.select(F.col("class").alias("a"), "n", F.col("bits").alias("p"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("bits").alias("q"))
    pairs = stage(found.where("kind = 0").select("a", "b").unionByName(stars).distinct().join(left, "a").join(right, "b")
                  .select("a", "b", "n", "m", "p", "q").mapInArrow(lean(passing), "a long, b long"), "pairs")

    def sets_of(batches):
        import pyarrow as pa

        for batch in batches:
            for part in ta.slices(batch, "text", ta.FEW_BYTES):
                doc, h = shingle_sets(part.column(1), n)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                name, blob = [], []
                for want, a, b in zip(part.column(0).to_pylist(), cut, cut[1:]):
                    if a < b and set_name(h[a:b]) == want:     # else another row of the same id
                        name.append(want)
                        blob.append(h[a:b].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(blob, pa.binary())],
                                                 ["class", "set"])

    def sets(wanted):
        """The sets of classes that need verifying, from one row of each class."""
        wanted = wanted.distinct().join(classes.select("class", "rep"), "class")
        keys = narrow(wanted.select(F.col("class").alias("expected"), F.col("rep").alias("doc_id")))
        return stage(docs.join(keys, "doc_id").select("expected", "text").mapInArrow(
            lean(sets_of), "class long, set binary").dropDuplicates(["class"]), "sets")

    def verified(batches):
        import pyarrow as pa

        for batch in batches:
            p, q = batch.column(2), batch.column(3)
            ok = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                  for x, y in zip(p, q)]
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in (0, 1)], ["a", "b"])

    own = sets(pairs.select(F.explode(F.array("a", "b")).alias("class")))
    light = stage(pairs.join(own.select(F.col("class").alias("a"), F.col("set").alias("p")), "a")
                  .join(own.select(F.col("class").alias("b"), F.col("set").alias("q")), "b")
                  .select("a", "b", "p", "q").mapInArrow(lean(verified), "a long, b long"), "links")
    if heavy.isEmpty():
        return light, classes
    groups = stage(components(light).select(F.col("node").alias("class"), F.col("component").alias("group")), "groups")
    light = groups.select(F.col("class").alias("a"), F.col("group").alias("b"))
    near = near_classes(heavy, classes, groups, percent)
    if near.isEmpty():
        return light, classes

    # clusters of classes that may link, with their sets
    cluster = components(near).select(F.col("node").alias("class"), F.col("component").alias("cluster"))
    member = stage(cluster.join(classes.select("class", "n"), "class").join(groups, "class", "left").withColumn(
        "group", F.coalesce("group", "class")), "members")
    with_set = sets(member.select("class"))
    member, tile = tiles(member, "cluster", SETS, percent)
    tile = stage(tile, "tiles")
    key = ["cluster", "band", "block", "band2", "block2"]
    with_set = member.join(with_set, "class")
    lefts = with_set.join(tile, ["cluster", "band", "block"]).select(
        *key, F.col("class").alias("l_class"), F.col("group").alias("l_group"), F.col("set").alias("l_set"))
    rights = (with_set.withColumnsRenamed({"band": "band2", "block": "block2"})
              .join(tile, ["cluster", "band2", "block2"])
              .select(*[F.col(k).alias(k) for k in key], F.col("class").alias("r_class"),
                      F.col("group").alias("r_group"), F.col("set").alias("r_set")))
    tiled = lefts.groupBy(*key).cogroup(rights.groupBy(*key)).applyInPandas(_tile_links(percent), "a long, b long")
    return stage(light.unionByName(tiled), "links"), classes


def join(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 5, percent: int = 80,
         hot_list: int = 400_000) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hot = hot_shingles(docs, words, hot_list)
    about = stage(described(docs, words, percent, hot), "described")
    edges, classes = links(docs, about, words, percent)
    parts = components(edges)
    root = classes.select("class", "rep").join(parts, F.col("class") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "class"))
    smallest = root.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = root.join(smallest, "component").select(F.col("class").alias("in_class"), "component_id")
    return (about.select("doc_id", "n", "class").join(named, F.col("class") == F.col("in_class"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
