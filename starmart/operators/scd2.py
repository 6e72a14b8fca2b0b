"""Type-2 history with the timestamp strategy (SCD-1 … SCD-5).

``scd2_snapshot`` is one snapshot run: it compares the source (one row per
key) with the *open* history rows and

* opens a row for a key it has never seen,
* closes the open row (``valid_to = source.updated_at``) and opens a new one
  when ``source.updated_at > open.valid_from``,
* leaves everything else alone — keys missing from the source stay open
  (hard deletes are ignored), closed rows are never touched.

The whole run is one full outer join of the open rows with the source on the
key, followed by a JVM-side ``inline`` that emits the (possibly closed) old
row and the (possibly new) row. Closed rows never need to be read again, so a
store can keep them append-only and feed only the open rows (one per key) to
the next run: each run costs O(keys + changes), not O(history).

``scd2_backfill`` is the closed form of many runs over a change log that is
cut into batches: per key and batch the latest change, kept when it is newer
than every earlier batch, and ``valid_to = lead(updated_at)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.keys import scd_id

META = ("scd_id", "valid_from", "valid_to")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``max_by`` is an aggregate with a map-side partial step, so a hot key is
    reduced to one row per input partition before the shuffle — a key holding
    a third of all rows never lands whole in one task.
    """
    payload = [c for c in df.columns if c != key]
    if not payload:
        return df.select(key).distinct()
    ordering = F.struct(*[F.col(c) for c in order])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in payload])


def _open_rows(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    return source.select(*source.columns,
                         scd_id(F.col(key), F.col(updated_at)).alias("scd_id"),
                         F.col(updated_at).alias("valid_from"),
                         F.lit(None).cast(source.schema[updated_at].dataType).alias("valid_to"))


def scd2_snapshot(history: DataFrame | None, source: DataFrame, key: str,
                  updated_at: str = "updated_at", tracked: list[str] | None = None,
                  source_unique: bool = False) -> DataFrame:
    """One snapshot run. ``history`` may hold all rows or just the open ones.

    The source must have one row per key; unless ``source_unique`` says it
    does (a keyed raw table), it is reduced to the latest row per key first.
    Skipping that step when it is known lets Catalyst read only the columns a
    query uses from the source.
    """
    cols = tracked or source.columns
    if key not in cols or updated_at not in cols:
        raise ValueError("tracked columns must include the key and updated_at")
    src = source.select(*cols) if source_unique else latest_per_key(source.select(*cols), key, [updated_at])
    if history is None:
        return _open_rows(src, key, updated_at)

    hist_cols = list(cols) + list(META)
    history = history.select(*hist_cols)
    closed = history.where(F.col("valid_to").isNotNull())
    open_ = history.where(F.col("valid_to").isNull())

    h = open_.select(F.col(key).alias("_k"), F.struct(*hist_cols).alias("h"), F.lit(True).alias("_h"))
    s = src.select(F.col(key).alias("_k2"), F.struct(*cols).alias("s"), F.lit(True).alias("_s"))
    j = h.join(s, h["_k"] == s["_k2"], "full")

    # the history side is detected by its presence flag, never by a NULL
    # valid_from (a NULL updated_at opens a row with a NULL valid_from)
    has_h = F.coalesce(F.col("_h"), F.lit(False))
    has_s = F.coalesce(F.col("_s"), F.lit(False))
    changed = has_h & has_s & F.coalesce(F.col(f"s.{updated_at}") > F.col("h.valid_from"), F.lit(False))

    old_row = F.when(has_h, F.struct(
        *[F.col(f"h.{c}").alias(c) for c in cols],
        F.col("h.scd_id").alias("scd_id"),
        F.col("h.valid_from").alias("valid_from"),
        F.when(changed, F.col(f"s.{updated_at}")).otherwise(F.col("h.valid_to")).alias("valid_to")))
    new_row = F.when(has_s & (~has_h | changed), F.struct(
        *[F.col(f"s.{c}").alias(c) for c in cols],
        scd_id(F.col(f"s.{key}"), F.col(f"s.{updated_at}")).alias("scd_id"),
        F.col(f"s.{updated_at}").alias("valid_from"),
        F.lit(None).cast(src.schema[updated_at].dataType).alias("valid_to")))
    rows = j.select(F.inline(F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())))
    return closed.unionByName(rows)


def scd2_backfill(changes: DataFrame, key: str, batch: Column | str,
                  updated_at: str = "updated_at", tracked: list[str] | None = None,
                  arrival: str | None = None) -> DataFrame:
    """History after one snapshot run per batch, in batch order, computed in one pass.

    The source seen by the run for batch *b* is the latest change of each key
    up to *b*. A key gets a new version in batch *b* only if its latest change
    there is newer than its current version.
    """
    cols = tracked or [c for c in changes.columns]
    b = F.col(batch) if isinstance(batch, str) else batch
    order = [updated_at] + ([arrival] if arrival else [])
    keep = list(dict.fromkeys(cols + order))
    per_batch = (changes.select(*keep, b.alias("_batch"))
                 .groupBy(key, "_batch")
                 .agg(F.max_by(F.struct(*[F.col(c) for c in keep if c != key]),
                               F.struct(*[F.col(c) for c in order])).alias("_r"))
                 .select(key, "_batch", *[F.col(f"_r.{c}").alias(c) for c in keep if c != key]))
    w = Window.partitionBy(key).orderBy("_batch")
    prior_max = F.max(F.col(updated_at)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    versions = (per_batch.withColumn("_prior", prior_max)
                .where(F.col("_prior").isNull() | (F.col(updated_at) > F.col("_prior"))))
    w2 = Window.partitionBy(key).orderBy("_batch")
    return versions.select(*cols,
                           scd_id(F.col(key), F.col(updated_at)).alias("scd_id"),
                           F.col(updated_at).alias("valid_from"),
                           F.lead(F.col(updated_at)).over(w2).alias("valid_to"))


def current_rows(history: DataFrame) -> DataFrame:
    """SCD-4: the open version of each key."""
    return history.where(F.col("valid_to").isNull())
