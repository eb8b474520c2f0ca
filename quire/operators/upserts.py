"""Keyed table updates as "next version of the table" frames.

No MERGE-capable table format is assumed. Each function returns the new
content of the table; the caller writes it to a fresh location and then
points readers at it (``quire.sinks.tables.replace_table``).

Scale notes:
* A batch that repeats a key is reduced with ``max_by``/``min_by`` under a
  total order: the caller's ``seq``, then the row's values. The aggregate has a
  map-side step, so a key that holds a third of the batch is cut to one row per
  task before the shuffle (a ``row_number`` window would sort that whole key
  in one task). Its struct buffer makes it a sort aggregate: tasks sort, and
  spill, their rows by key.
* A NULL key fails the job: it could be neither matched nor kept.
* After that reduction both sides are unique on the key, so the joins are
  1:1.
* The reduced batch is staged (written once to the shared checkpoint
  folder, ``layout.stage``). The planner then knows its size: a small
  batch is broadcast and the old table is only scanned, never shuffled; a
  large one gets a sort-merge join. When the batch is on the left of the
  anti join (insert-if-absent, append), the overlap is first found by a
  semi join of the old table's keys against the batch, so the old table
  is still only scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.layout import stage

def checked_key(key: str) -> Column:
    """The key column; a NULL in it fails the job."""
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL in key column {key}"))) \
            .otherwise(F.col(key)).alias(key)


def _reduce_per_key(new: DataFrame, key: str, seq: str | None, last: bool) -> DataFrame:
    """One row per key under the order (seq, values); without ``seq`` the
    values alone decide, so the result never depends on the rows' layout."""
    others = [c for c in new.columns if c not in (key, seq)]
    keyed = new.withColumn(key, checked_key(key))
    if not others:
        return keyed.select(key).distinct()
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in others])
    order = F.struct(F.col(seq), row) if seq else row
    return (keyed.groupBy(key).agg(pick(row, order).alias("__row"))
                 .select(key, *[F.col("__row")[c].alias(c) for c in others]))


def latest_per_key(new: DataFrame, key: str = "id", seq: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``seq`` (last wins)."""
    return _reduce_per_key(new, key, seq, last=True)


def first_per_key(new: DataFrame, key: str = "id", seq: str | None = None) -> DataFrame:
    """One row per key: the one with the lowest ``seq`` (first wins)."""
    return _reduce_per_key(new, key, seq, last=False)


def _conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like`` in its order and types; absent ones are NULL."""
    cols = []
    for f in like.schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def upsert_replace(old: DataFrame, new: DataFrame, key: str = "id",
                   seq: str | None = None) -> DataFrame:
    """Whole-row replace by key (G1): a new row replaces the old one, and
    columns the batch does not supply become NULL; within a batch the last
    row of a key wins."""
    fresh = stage(latest_per_key(new, key, seq), "upsert")
    kept = old.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(_conform(fresh, old))


def insert_if_absent(old: DataFrame, new: DataFrame, key: str = "id",
                     seq: str | None = None) -> DataFrame:
    """Add a key only when it is not there yet (G2); within a batch the first
    row of a key wins."""
    fresh = stage(first_per_key(new, key, seq), "insert")
    return old.unionByName(_conform(_not_in(fresh, old, key), old))


def _not_in(fresh: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of the (staged, unique-key) batch whose key is not in ``old``.
    The overlap comes from a semi join of ``old``'s keys against the batch,
    which the planner broadcasts when the batch is small."""
    overlap = old.select(key).join(fresh.select(key), key, "left_semi")
    return fresh.join(overlap, key, "left_anti")


def partial_update(old: DataFrame, new: DataFrame, cols: list[str], key: str = "id",
                   seq: str | None = None) -> DataFrame:
    """Overwrite ``cols`` with the batch's non-NULL values (G3). Keys not
    in ``old`` are ignored, as an UPDATE of a missing row changes nothing. Of a
    repeated key each column takes its own last non-NULL value, as a sequence of
    updates would leave it."""
    return apply_update(old, reduce_update(new, cols, key, seq), cols, key)


def reduce_update(new: DataFrame, cols: list[str], key: str = "id", seq: str | None = None) -> DataFrame:
    """The batch of a partial update reduced to one row per key, written once:
    per column the last non-NULL value (by ``seq``, else the largest)."""
    def last(c):
        order = F.struct(F.col(seq), F.col(c)) if seq else F.col(c)
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
    keyed = new.withColumn(key, checked_key(key))
    return stage(keyed.groupBy(key).agg(*[last(c) for c in cols]), "update")


def apply_update(old: DataFrame, reduced: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    """``old`` with a reduced batch's non-NULL values."""
    fresh = reduced.select(key, *[F.col(c).alias(f"__new_{c}") for c in cols])
    joined = old.join(fresh, key, "left")
    out = [F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
           for c in old.columns]
    return joined.select(*out)


def upsert_summary(old: DataFrame, new: DataFrame, key: str = "id",
                   summary: str = "summary") -> DataFrame:
    """Replace summaries by id (G4). A NULL (failed) summary is never
    written, so the previous one stays."""
    return upsert_replace(old, new.filter(F.col(summary).isNotNull()), key)


def set_selected(old: DataFrame, verdicts: DataFrame, key: str = "id",
                 col: str = "selected") -> DataFrame:
    """Write yes/no verdicts by id."""
    return partial_update(old, verdicts.select(key, col), [col], key)


def append_new(previous: DataFrame, new: DataFrame, key: str = "id",
               seq: str | None = None) -> DataFrame:
    """Previous rows plus new rows for keys not seen before (G9). Re-running
    with the same batch changes nothing."""
    fresh = stage(first_per_key(new, key, seq), "append")
    return previous.unionByName(_conform(_not_in(fresh, previous, key), previous))


def verify_update(after: DataFrame, new: DataFrame, cols: list[str],
                  key: str = "id") -> DataFrame:
    """Read-back check of a partial update (G11): per updated key, did every
    non-NULL new value land. ``new`` is the reduced batch (``reduce_update``).
    Columns: (key, verified)."""
    a = after.select(key, *[F.col(c).alias(f"__after_{c}") for c in cols])
    checks = [F.col(c).isNull() | F.col(c).eqNullSafe(F.col(f"__after_{c}")) for c in cols]
    ok = checks[0]
    for c in checks[1:]:
        ok = ok & c
    any_new = F.lit(False)
    for c in cols:
        any_new = any_new | F.col(c).isNotNull()
    return (new.filter(any_new).join(a, key, "inner")
                 .select(key, ok.alias("verified")))
