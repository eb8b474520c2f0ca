"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped into buckets of similar length (bands of ``ratio``), and a
band into tiles of bounded size. A first pass over the tile of longest vectors
gives each query a score that its k-th best can't fall below. With that, a
tile's local cosine threshold for a query is threshold / (|q| * longest): over
1, the tile is skipped; when it is high, the feasible intervals of the query's
largest coordinates prune (coordinate pruning), otherwise the vectors too short
to reach the threshold do (length pruning). What is left is verified by exact
integer products. Nothing is pruned that could tie with the k-th best.

Queries meet rows in blocks: a task gets one block of queries and one tile, and
returns at most k rows a query.

Components are floor(scale * x). Rows are told apart by a stored row number, so
rows that repeat a vec_id are queries and candidates of their own; only a query's
own row is left out. Ties go to the smaller vec_id.

Defined cases: a vector that is null or holds a null or non-finite component
takes no part, nor does a null vec_id; vectors of different length are compared
over their common components; an empty table gives no rows. Products of vectors
with a norm of 2**31 or more are computed in Python integers, without pruning: they
rank by their exact value (up to 38 digits), and a score that a long can't hold is
null. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stage
from quire.llm.cover_codes import big_integers, matrix, usable

#: Relative slack of the pruning bounds against rounding.
SLACK = 1e-9


def integers(vectors: DataFrame, id_col="vec_id", vec_col="embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, v, big, len): v the little-endian int64 components (of ``big``
    vectors their decimal digits), len the norm."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            width = max(batch.column(1).value_lengths().to_pylist(), default=0)
            x = matrix(batch.column(1), width)
            with np.errstate(over="ignore"):
                scaled = np.floor(scale * x)
                norm = np.sqrt((scaled * scaled).sum(1))
            big = ~(norm < 2.0 ** 31)
            text = np.where(big[:, None], 0.0, scaled).astype("<i8").tobytes()
            v = [text[i * 8 * width:(i + 1) * 8 * width] for i in range(batch.num_rows)]
            for i in np.flatnonzero(big).tolist():
                v[i] = ",".join(map(str, big_integers(x[i:i + 1], scale)[0])).encode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(v, pa.binary()), pa.array(big), pa.array(norm)],
                                             ["vec_id", "v", "big", "len"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).mapInArrow(
        run, "vec_id long, v binary, big boolean, len double")


def _matrix(column, big) -> np.ndarray:
    """The components as rows, padded with zeros; Python integers if any is big."""
    parts = [[int(x) for x in bytes(b).decode().split(",")] if is_big else np.frombuffer(b, "<i8")
             for b, is_big in zip(column, big)]
    out = np.zeros((len(parts), max(map(len, parts), default=0)), object if any(big) else np.int64)
    for row, p in zip(out, parts):
        row[:len(p)] = p if out.dtype != object else [int(x) for x in p]
    return out


def _low(score) -> float:
    """A float that isn't above an exact score."""
    if isinstance(score, (int, np.integer)) and abs(int(score)) < 1 << 52:
        return float(score)
    if abs(int(score)) < 1 << 1000:
        return float(np.nextafter(float(int(score)), -math.inf))
    return -math.inf if score < 0 else 2.0 ** 1000


def _best(got, ids, s, k: int):
    """The k best of the scores, ties to smaller ids, as (rows, ids, scores)."""
    order = sorted(range(len(s)), key=lambda i: (-int(s[i]), int(ids[i])))[:k] if s.dtype == object \
        else np.lexsort((ids, -s))[:k]
    return got[order], ids[order], s[order]


def best_in_tile(q_rows, q, theta, rows, ids, y, k: int, sharp: float = 0.5, focus: int = 3):
    """Per query: (place of the query, rows, vec ids, scores) of its best k in
    the tile with a score of at least its theta; a query's own row is left out."""
    d = min(q.shape[1], y.shape[1])
    q, y = q[:, :d], y[:, :d]
    if object in (q.dtype, y.dtype):                   # big vectors: exact, without pruning
        q, y = q.astype(object), y.astype(object)
        for i in range(len(q_rows)):
            s = np.array([sum(a * b for a, b in zip(q[i], row)) for row in y], object)
            ok = np.array([r != q_rows[i] and v >= theta[i] for r, v in zip(rows, s)], bool)
            if ok.any():
                yield i, *_best(rows[ok], ids[ok], s[ok], k)
        return
    y_len = np.sqrt((y.astype(np.float64) ** 2).sum(1))
    by_len = np.argsort(-y_len, kind="stable")
    rows, ids, y, y_len = rows[by_len], ids[by_len], y[by_len], y_len[by_len]
    longest = float(y_len[0]) if len(y_len) else 0.0
    unit = y / np.maximum(y_len, 1e-300)[:, None]
    exact = y.astype(np.float64)
    q_len = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    for i in range(len(q_rows)):
        low, ql = theta[i], q_len[i]
        bound = ql * longest
        if bound * (1 + SLACK) < low:
            continue                                   # local cosine threshold over 1
        n = len(ids)
        pick = slice(0, n)
        if low > 0 and bound > 0:
            # length pruning: only vectors with |q| * |y| >= theta
            n = int(np.searchsorted(-y_len, -(low / ql) * (1 - SLACK), "right"))
            pick = slice(0, n)
            cosine = low / bound
            if cosine >= sharp:                        # coordinate pruning
                qu = q[i] / ql
                keep = np.ones(n, bool)
                for f in np.argsort(-np.abs(qu))[:focus]:
                    half = math.sqrt(max(0.0, 1 - cosine * cosine) * max(0.0, 1 - qu[f] * qu[f]))
                    u = unit[:n, f]
                    # the unit vectors within the cosine of q have this coordinate
                    # in [cos * q_f - half, cos * q_f + half], or beyond it on q's side
                    if qu[f] > 0:
                        keep &= u >= qu[f] * cosine - half - 1e-7
                    else:
                        keep &= u <= qu[f] * cosine + half + 1e-7
                pick = np.flatnonzero(keep)
        if bound < 2.0 ** 52:                          # float products are exact here
            s = (exact[pick] @ q[i].astype(np.float64)).astype(np.int64)
        else:
            s = y[pick] @ q[i]
        got, own = rows[pick], ids[pick]
        ok = (s >= low) & (got != q_rows[i])
        s, got, own = s[ok], got[ok], own[ok]
        if len(s) > k:
            kth = np.partition(s, len(s) - k)[len(s) - k]
            ok = s >= kth
            got, own, s = _best(got[ok], own[ok], s[ok], k)
        if len(s):
            yield i, got, own, s


#: A score beyond a long is carried as the nearest long, its digits beside it.
MOST = (1 << 63) - 1


def _found(blocks, query_rows, query_ids) -> pd.DataFrame:
    from decimal import Decimal

    out = {"query_row": [], "query_id": [], "vec_id": [], "score": [], "digits": []}
    for i, _, ids, s in blocks:
        out["query_row"] += [int(query_rows[i])] * len(s)
        out["query_id"] += [int(query_ids[i])] * len(s)
        out["vec_id"] += ids.tolist()
        out["score"] += np.clip(s, -MOST - 1, MOST).tolist()
        out["digits"] += [None] * len(s) if s.dtype != object else [
            Decimal(max(min(v, 10 ** 38 - 1), 1 - 10 ** 38)) if abs(v) >= MOST else None for v in s]
    return pd.DataFrame(out).astype({c: "int64" for c in ("query_row", "query_id", "vec_id", "score")})


def search(vectors: DataFrame, is_query, k: int = 20, id_col="vec_id", vec_col="embedding",
           scale: float = 64.0, tile_rows: int = 4096, block_rows: int = 2048, ratio: float = 1.1) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of each query
    (rows with ``is_query(id column)``) with all other rows, ties to the
    smaller vec_id."""
    base = stage(integers(vectors, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    band = F.when(F.col("len") > 0, F.floor(F.log(F.least(F.col("len"), F.lit(1e308))) / math.log(ratio))).otherwise(
        F.lit(-1)).cast("long")
    banded = base.withColumn("band", band)
    # lengths of ordinary vectors are under 2 ** 31: a few hundred bands; of doubles, some 8,000 at most
    per_band = {r["band"]: r["n"] for r in banded.groupBy("band").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("row")
    cuts = F.create_map(*[F.lit(x).cast("long") for b, n in sorted(per_band.items()) for x in (b, -(-n // tile_rows))] or
                        [F.lit(-1).cast("long"), F.lit(1).cast("long")])
    tiles = banded.withColumn("salt", F.pmod(h, F.element_at(cuts, F.col("band")).cast("long")))
    marks = tiles.groupBy("band", "salt").agg(F.max("len").alias("longest"), F.count("*").alias("rows"))
    seed = marks.where(F.col("rows") > k).orderBy(F.desc("longest"), "band", "salt").first() \
        or marks.orderBy(F.desc("longest"), "band", "salt").first()
    queries = base.where(is_query(F.col("vec_id")))
    n_blocks = -(-queries.count() // block_rows)
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if seed is None or not n_blocks:
        return empty
    tiles = tiles.select("band", "salt", F.col("row").alias("t_row"), F.col("vec_id").alias("t_id"),
                         F.col("v").alias("t_v"), F.col("big").alias("t_big"))
    cols = ["block", "row", "vec_id", "v", "big", "len"]
    blocked = queries.withColumn("block", F.pmod(h, F.lit(n_blocks))).select(*cols)

    def in_tile(rows, theta, tile):
        return best_in_tile(rows["row"].to_numpy(), _matrix(rows["v"], rows["big"]), theta, tile["t_row"].to_numpy(),
                            tile["t_id"].to_numpy(), _matrix(tile["t_v"], tile["t_big"]), k)

    def first_pass(rows: pd.DataFrame, seeds: pd.DataFrame) -> pd.DataFrame:
        theta = np.full(len(rows), -math.inf)
        if len(rows) and len(seeds):
            for i, _, _, s in in_tile(rows, theta.copy(), seeds):
                if len(s) >= k:
                    theta[i] = _low(sorted(s.tolist(), reverse=True)[k - 1])
        return rows.assign(theta=theta)[[*cols, "theta"]]

    one = tiles.where((F.col("band") == seed["band"]) & (F.col("salt") == seed["salt"]))
    seeds = one.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "t_row", "t_id", "t_v", "t_big")
    known = stage(blocked.groupBy("block").cogroup(seeds.groupBy("block")).applyInPandas(
        first_pass, "block long, row long, vec_id long, v binary, big boolean, len double, theta double"), "thresholds")

    def search_tile(rows: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        out = list(in_tile(rows, rows["theta"].to_numpy(), tile)) if len(rows) and len(tile) else []
        return _found(out, rows["row"].to_numpy(), rows["vec_id"].to_numpy())

    # every query block meets every tile that one of its queries can need
    needs = known.groupBy("block").agg(F.max(F.col("len")).alias("q_len"), F.min("theta").alias("theta"))
    spots = marks.select("band", "salt", "longest", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"))
    reach = F.col("q_len") * F.col("longest") * (1 + SLACK)
    meet = stage(spots.join(needs, "block").where(F.isnan(reach) | (reach >= F.col("theta")))
                 .select("block", "band", "salt"), "meetings")
    key = ["block", "band", "salt"]
    left = known.join(meet, "block").groupBy(*key)
    right = tiles.join(meet, ["band", "salt"]).groupBy(*key)
    found = left.cogroup(right).applyInPandas(
        search_tile, "query_row long, query_id long, vec_id long, score long, digits decimal(38,0)")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.desc("digits"), "vec_id")
    fits = F.col("digits").isNull() | (F.abs("digits") <= F.lit(str(MOST)).cast("decimal(38,0)"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.when(fits, F.col("score")).alias("score")))
