"""Vector code compression: product codes by Lloyd rounds over cover trees.

Vectors become integers floor(scale * x), are cut into equal consecutive parts,
and each part position has a codebook. A part's code is its nearest entry.

1. Trees. Blocks of at most ``tree_rows`` vectors grow one cover tree per part
   position, inside the task that reads them: a node's points lie within its
   radius of its centre; its children's centres are more than half that radius
   apart and cover it with half that radius (the simplified cover tree's rules).
   Points are stored in tree order, so a subtree is a range of rows and its sum
   is a difference of two cumulative sums. The trees are written once and read
   by every round.
2. A round walks each tree from the root. When a node's centre is nearer to its
   best entry than to any other by more than twice the radius, the triangle
   inequality gives the whole subtree to that entry, by its cumulative sums;
   other nodes are opened, and only the points of ambiguous leaves are compared
   with the entries one by one. A task returns one sum and count per entry.
3. The codebook (parts x entries, a size fixed by the parameters) is the only
   thing that the driver holds.

All results are exact: squared distances stay under 2**52, where float products
of integers are exact, and blocks or entries beyond that are compared with
Python integers.

Defined cases: a vector that is null or holds a null, NaN or infinite component
takes no part and has no row; a null id or label is kept (ids order nulls last);
rows that repeat an id are rows of their own (ties by the vector); vectors are
padded with zeros to the longest one, rounded up to a multiple of the parts;
with fewer rows than entries the codebook has as many entries as rows; an empty
table gives no rows; an error that a long can't hold is null, as is its label's
sum; columns other than the three named ones are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.llm.common import narrow, stage

#: Sums travel as limbs of so many bits, so that they add up exactly as longs.
LIMB = 40


def usable(v):
    """A vector without null, NaN or infinite components."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))


def matrix(column, width: int) -> np.ndarray:
    """Float64 rows of an Arrow list column, padded with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = np.diff(np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]))
    length = length.astype(np.int64)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)] = values
    return out


def big_integers(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as Python integers, of any size."""
    def one(v):
        n, d = float(v).as_integer_ratio()
        m, e = float(scale).as_integer_ratio()
        return (n * m) // (d * e)
    return np.array([[one(v) for v in row] for row in x], object).reshape(x.shape)


def safe(width: int) -> int:
    """Components below this keep squared distances under 2**52."""
    return math.isqrt((1 << 50) // max(width, 1))


# ------------------------------------------------------------------- the tree

def grow(points: np.ndarray, leaf: int = 32) -> dict[str, np.ndarray]:
    """The cover tree of integer ``points``: ``order`` (rows in tree order) and
    per node the range lo..hi of that order, whose first point is the centre,
    the radius, and the range first..last of its children (none: first < 0).
    Nodes are in breadth-first order."""
    order = np.arange(len(points))
    lo, hi, radius, first, last = [0], [len(points)], [0.0], [-1], [-1]
    x = points.astype(np.float64)
    i = 0
    while i < len(lo):
        rows = order[lo[i]:hi[i]].copy()
        far = ((x[rows] - x[rows[0]]) ** 2).sum(1)
        most = far.max() if len(rows) else 0.0
        radius[i] = math.sqrt(most)
        if len(rows) > leaf and most > 0:
            first[i], at = len(lo), lo[i]
            while len(rows):
                near = far <= most / 4
                child = rows[near]
                order[at:at + len(child)] = child
                lo.append(at)
                at += len(child)
                hi.append(at)
                radius.append(0.0)
                first.append(-1)
                last.append(-1)
                rows = rows[~near]
                if len(rows):
                    far = ((x[rows] - x[rows[0]]) ** 2).sum(1)
            last[i] = len(lo)
        i += 1
    return {"order": order.astype("<i4"), "lo": np.array(lo, "<i4"), "hi": np.array(hi, "<i4"),
            "radius": np.array(radius, "<f8"), "first": np.array(first, "<i4"), "last": np.array(last, "<i4")}


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    n = hi - lo
    return np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


class Entries:
    """One part's codebook: of equal entries only the first can be nearest."""

    def __init__(self, entries: list[tuple[int, ...]]):
        seen: dict[tuple, int] = {}
        for i, e in enumerate(entries):
            seen.setdefault(e, i)
        self.n, self.index, self.exact = len(entries), np.array(list(seen.values())), list(seen)
        self.most = max((abs(v) for e in seen for v in e), default=0)
        if self.most < 2 ** 31:
            self.y = np.array(self.exact, np.float64)
            self.norm = (self.y * self.y).sum(1)

    def squares(self, points: np.ndarray) -> np.ndarray:
        return ((points * points).sum(1)[:, None] - 2.0 * (points @ self.y.T)) + self.norm


def walk(tree: dict[str, np.ndarray], points: np.ndarray, book: Entries):
    """Yields (entry, lo, hi) arrays of subtrees given away whole, and (entry,
    rows) of points compared one by one; entries are positions in ``book``."""
    nodes = np.array([0])
    while len(nodes):
        d = book.squares(points[tree["lo"][nodes]])
        best = d.argmin(1)
        near = np.sqrt(d[np.arange(len(nodes)), best])
        d[np.arange(len(nodes)), best] = np.inf
        sure = near + 2 * tree["radius"][nodes] < np.sqrt(d.min(1)) * (1 - 1e-9)
        yield best[sure], tree["lo"][nodes[sure]].astype(np.int64), tree["hi"][nodes[sure]].astype(np.int64)
        doubt = nodes[~sure]
        leaf = tree["first"][doubt] < 0
        rows = ranges(tree["lo"][doubt[leaf]].astype(np.int64), tree["hi"][doubt[leaf]].astype(np.int64))
        if len(rows):
            yield book.squares(points[rows]).argmin(1), rows
        inner = doubt[~leaf]
        nodes = ranges(tree["first"][inner].astype(np.int64), tree["last"][inner].astype(np.int64))


def nearest_exact(points: np.ndarray, book: Entries) -> tuple[np.ndarray, list[int]]:
    """(entry, squared distance) of each row, in Python integers."""
    label, error = [], []
    for p in points.tolist():
        d = [sum((a - b) ** 2 for a, b in zip(p, e)) for e in book.exact]
        label.append(min(range(len(d)), key=d.__getitem__))
        error.append(d[label[-1]])
    return np.array(label, np.int64), error


# ------------------------------------------------------------------- the jobs

def forest(rows: DataFrame, width: int, parts: int, scale: float, tree_rows: int, leaf: int) -> DataFrame:
    """One row per block of vectors (vec_id, label, v): its ids, its labels and a
    tree with its points per part; ``big`` blocks hold their doubles instead."""
    label = rows.schema["label"].dataType.simpleString()
    step = width // parts
    schema = (f"ids array<bigint>, labels array<{label}>, big binary, trees array<struct<points: binary, "
              "order: binary, lo: binary, hi: binary, radius: binary, first: binary, last: binary>>")

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        kind = pa.struct([(n, pa.binary()) for n in ("points", "order", "lo", "hi", "radius", "first", "last")])
        arrow = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(to_arrow_type(label_type))),
                           ("big", pa.binary()), ("trees", pa.list_(kind))])
        for batch in batches:
            for at in range(0, batch.num_rows, tree_rows):
                block = batch.slice(at, tree_rows)
                x = matrix(block.column(2), width)
                scaled = np.floor(scale * x)
                big, trees = None, []
                if np.abs(scaled).max(initial=0) < safe(step):
                    for p in range(parts):
                        part = scaled[:, p * step:(p + 1) * step]
                        tree = grow(part, leaf)
                        points = np.ascontiguousarray(part[tree["order"]]).astype("<i4")
                        trees.append({"points": points.tobytes(), **{k: v.tobytes() for k, v in tree.items()}})
                else:
                    big = x.astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.column(0)], arrow[0].type), pa.array([block.column(1)], arrow[1].type),
                     pa.array([big], pa.binary()), pa.array([trees], arrow[3].type)], schema=arrow)

    label_type = rows.schema["label"].dataType
    return rows.select("vec_id", "label", "v").mapInArrow(run, schema)


def _blocks(batches, width: int, parts: int, scale: float):
    """(row of the forest, its trees with arrays or None, its big integers or None)."""
    step = width // parts
    for batch in batches:
        for r in range(batch.num_rows):
            big = batch.column("big")[r]
            if big.is_valid:
                x = np.frombuffer(big.as_py(), "<f8").reshape(-1, width)
                yield batch, r, None, big_integers(x, scale)
                continue
            trees = []
            for t in batch.column("trees")[r].values.to_pylist():
                trees.append({k: np.frombuffer(t[k], "<f8" if k == "radius" else "<i4") for k in t}
                             | {"points": np.frombuffer(t["points"], "<i4").reshape(-1, step).astype(np.float64)})
            yield batch, r, trees, None


def _as_big(tree: dict[str, np.ndarray]) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in tree["points"]], object).reshape(tree["points"].shape)


def entry_sums(trees: DataFrame, books: list[list[tuple[int, ...]]], width: int, scale: float) -> DataFrame:
    """(part, entry, pos, limb, value): each entry's parts added up per task, as
    limbs of ``LIMB`` bits; pos -1 counts them."""
    parts = len(books)
    step = width // parts

    def run(batches):
        import pyarrow as pa

        told = [Entries(b) for b in books]
        limit = safe(step)
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros((len(b), step), np.int64) for b in books]
        huge: dict[tuple[int, int, int], int] = {}
        for _, _, forest_row, whole in _blocks(batches, width, parts, scale):
            for p, book in enumerate(told):
                if whole is not None or book.most >= limit:
                    x = whole[:, p * step:(p + 1) * step] if whole is not None else _as_big(forest_row[p])
                    label, _ = nearest_exact(x, book)
                    for e, row in zip(book.index[label].tolist(), x.tolist()):
                        count[p][e] += 1
                        for j, v in enumerate(row):
                            huge[p, e, j] = huge.get((p, e, j), 0) + v
                    continue
                tree, x = forest_row[p], forest_row[p]["points"]
                points = x.astype(np.int64)
                sums = np.concatenate([np.zeros((1, step), np.int64), np.cumsum(points, axis=0)])
                for found in walk(tree, x, book):
                    e = book.index[found[0]]
                    if len(found) == 3:
                        np.add.at(count[p], e, found[2] - found[1])
                        np.add.at(total[p], e, sums[found[2]] - sums[found[1]])
                    else:
                        np.add.at(count[p], e, 1)
                        np.add.at(total[p], e, points[found[1]])
        out = []
        for p in range(parts):
            for e in np.flatnonzero(count[p]).tolist():
                out.append((p, e, -1, 0, int(count[p][e])))
                for j in range(step):
                    v, limb = int(total[p][e, j]) + huge.get((p, e, j), 0), 0
                    while v not in (0, -1):
                        v, low = divmod(v, 1 << LIMB)
                        out.append((p, e, j, limb, low))
                        limb += 1
                    if v:
                        out.append((p, e, j, limb, v))
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["part", "entry", "pos", "limb", "value"])

    return (trees.mapInArrow(run, "part int, entry int, pos int, limb int, value long")
            .groupBy("part", "entry", "pos", "limb").agg(F.sum("value").alias("value")))


def next_books(books: list[list[tuple[int, ...]]], sums: DataFrame) -> list[list[tuple[int, ...]]]:
    """Every entry replaced by floor(sum / count) of its parts; unused ones stay.
    The rows are at most entries x width x limbs."""
    value: dict[tuple[int, int, int], int] = {}
    for r in sums.collect():
        key = r["part"], r["entry"], r["pos"]
        value[key] = value.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    return [[tuple(value.get((p, e, j), 0) // value[p, e, -1] for j in range(len(old)))
             if (p, e, -1) in value else old for e, old in enumerate(book)] for p, book in enumerate(books)]


def codes(trees: DataFrame, books: list[list[tuple[int, ...]]], width: int, scale: float) -> DataFrame:
    """(vec_id, label, code, error) of every vector under the final codebooks."""
    parts = len(books)
    step = width // parts
    label_type = trees.schema["labels"].dataType.elementType

    def run(batches):
        import pyarrow as pa

        told = [Entries(b) for b in books]
        for batch, r, forest_row, whole in _blocks(batches, width, parts, scale):
            ids = batch.column("ids")[r].values
            code = np.zeros((len(ids), parts), np.uint8)
            error, huge = np.zeros(len(ids), np.int64), [0] * len(ids)
            for p, book in enumerate(told):
                if whole is not None or book.most >= safe(step):
                    x = whole[:, p * step:(p + 1) * step] if whole is not None else _as_big(forest_row[p])
                    rows = np.arange(len(ids)) if whole is not None else forest_row[p]["order"]
                    label, d = nearest_exact(x, book)
                    code[rows, p] = book.index[label]
                    for row, v in zip(rows.tolist(), d):
                        huge[row] += v
                    continue
                tree, x = forest_row[p], forest_row[p]["points"]
                label = np.zeros(len(ids), np.int64)
                for found in walk(tree, x, book):
                    if len(found) == 3:
                        label[ranges(found[1], found[2])] = np.repeat(found[0], found[2] - found[1])
                    else:
                        label[found[1]] = found[0]
                code[tree["order"], p] = book.index[label]
                error[tree["order"]] += ((x - book.y[label]) ** 2).sum(1).astype(np.int64)
            total = [int(a) + b for a, b in zip(error, huge)] if any(huge) else error.tolist()
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("labels")[r].values,
                 pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array([v if v < 1 << 63 else None for v in total], pa.int64())],
                ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id long, label {label_type.simpleString()}, code string, error long")


def compress(vectors: DataFrame, id_col="vec_id", vec_col="embedding", label_col="label", parts: int = 16,
             entries: int = 64, rounds: int = 2, scale: float = 256.0, tree_rows: int = 2048,
             leaf: int = 32) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), one row per
    usable vector; ``entries`` is at most 256 (two hex digits a part)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(usable(F.col("v")))
    # one scan finds the first entries and, beside it, the longest vector
    seen = Observation("widths")
    start = (rows.observe(seen, F.max(F.size("v")).alias("width")).select("vec_id", "v")
             .orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect())
    if not start:
        kind = rows.schema["label"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long, "
                                                        "label_error long, codebooks_sha256 string")
    width = parts * max(1, math.ceil(seen.get["width"] / parts))
    step = width // parts
    first = np.zeros((len(start), width))
    for out, r in zip(first, start):
        out[:len(r["v"])] = r["v"]
    ints = big_integers(first, scale).tolist()
    books = [[tuple(row[p * step:(p + 1) * step]) for row in ints] for p in range(parts)]
    trees = stage(forest(rows, width, parts, scale, tree_rows, leaf), "trees")
    for _ in range(rounds):
        books = next_books(books, entry_sums(trees, books, width, scale))
    text = ",".join(str(v) for book in books for e in book for v in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    coded = stage(codes(trees, books, width, scale), "codes")
    whole = F.count("error") == F.count(F.lit(1))
    per_label = coded.groupBy(F.col("label").alias("same")).agg(
        F.when(whole, F.try_sum("error")).alias("label_error"))
    per_label = narrow(per_label)
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("same")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
