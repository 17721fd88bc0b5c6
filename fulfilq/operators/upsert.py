"""Upsert (S9a-d) and SCD2 re-close (X21) as pure DataFrame operators.

``DELETE FROM target USING staging WHERE key = key; INSERT staging`` is a
left-anti join of the target against the batch keys plus a union with the
batch. The anti join is a hash-partitioned join on the business key (AQE
broadcasts the batch side when it is measured small). Required keys are never
NULL (the cleanse jobs drop such rows); if a target holds one all the same, it
never matches and is kept, as with ``DELETE USING``. Capacity snapshots have no
required columns, so there NULL keys match each other and a re-run replaces
them. Running the same batch twice gives the same table (idempotent).

With ``latest_by`` a batch row loses only against a newer record of its key: one
with a greater ``latest_by`` or, at equal times, a greater order of arrival
(``load_seq``, where both sides carry it). The batch wins every other tie: it
arrived later. So an update at the same event time is taken, a stale record is
not, and with ``load_seq`` the result does not depend on the order of the batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulfilq.operators.cleanse import dedup_latest, scd2_versions
from fulfilq.schemas import GONE, LOAD_SEQ, LOAD_STAMP


def newest(df: DataFrame, keys: Sequence[str], latest_by: str | None) -> DataFrame:
    """One row per key: the latest (ties by order of arrival, the other columns, load time last); rows with a NULL key all stay."""
    has_null = _has_null(keys)
    order = latest_by if latest_by is not None else F.lit(0)
    ties = [c for c in df.columns if c not in (*keys, latest_by, LOAD_STAMP, LOAD_SEQ)]
    ties += [LOAD_STAMP] if LOAD_STAMP in df.columns else []
    one = dedup_latest(df.where(~has_null), keys, F.col(latest_by) if latest_by else order, tiebreak=ties)
    return one.unionByName(df.where(has_null))


def _has_null(keys: Sequence[str]):
    keys = list(keys)
    return F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()


def order_columns(df: DataFrame, latest_by: str | None) -> list[Column]:
    """``_at`` and ``_seq`` of a row: what decides which of two records of a key is newer."""
    at = F.col(latest_by) if latest_by is not None else F.lit(None)
    seq = F.col(LOAD_SEQ) if LOAD_SEQ in df.columns else F.lit(None)
    return [at.cast("timestamp").alias("_at"), seq.cast("bigint").alias("_seq")]


def meetings(stored: DataFrame, batch: DataFrame, keys: Sequence[str], latest_by: str | None,
             columns: Sequence[str] = ()) -> DataFrame:
    """Keys that ``stored`` and ``batch`` both hold, with ``columns`` of the stored row and ``stored_newer``.

    Both sides are narrow (keys and order); the batch has one row per key. NULL keys do not meet.
    """
    keys = list(keys)
    theirs = stored.where(~_has_null(keys)).select(*keys, *columns, *order_columns(stored, latest_by))
    ours = batch.where(~_has_null(keys)).select(*keys, *[c.alias("_batch" + n) for c, n in zip(
        order_columns(batch, latest_by), ("_at", "_seq"), strict=True)])
    later = (F.col("_at") > F.col("_batch_at")) | (F.col("_at").isNotNull() & F.col("_batch_at").isNull())
    tie = F.col("_at").eqNullSafe(F.col("_batch_at")) & (F.col("_seq") > F.col("_batch_seq"))
    newer = F.coalesce(later, F.lit(False)) | F.coalesce(tie, F.lit(False))
    return _hashed(theirs, keys).join(_hashed(ours, keys), ["_hash", *keys]).select(*keys, *columns, newer.alias("stored_newer"))


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys' hash in front: a join on it too sorts by a well-spread number, as ids with a long common prefix do not."""
    return df.withColumn("_hash", F.xxhash64(*keys))


def without_keys(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``gone``. NULL keys bypass the join: they are not hashed into one partition."""
    keys = list(keys)
    has_null = _has_null(keys)
    kept = _hashed(rows.where(~has_null), keys).join(
        _hashed(gone.select(*keys).distinct(), keys), on=["_hash", *keys], how="left_anti").select(*rows.columns)
    return rows.where(has_null).unionByName(kept)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """Target rows whose key is absent from the batch, plus every batch row.

    ``latest_by``: a batch row (one per key) whose key the target holds in a newer
    record stays out, and that record stays.
    """
    keys = list(keys)
    if latest_by is not None:
        newer = meetings(target, batch, keys, latest_by).where("stored_newer")
        batch = without_keys(batch, newer, keys)
    batch_keys = batch.select(*keys).where(~_has_null(keys))  # distinct below: hot keys collapse map-side
    return without_keys(target, batch_keys, keys).unionByName(batch.select(*target.columns))


def settle_quarantine(batch: DataFrame, quarantine: DataFrame | None, keys: Sequence[str],
                      latest_by: str, keep=None) -> tuple[DataFrame, DataFrame]:
    """(batch without the rows that a quarantined record beats, the new quarantine).

    The quarantine remembers the keys whose newest record is incomplete, with
    that record's time and order of arrival: a complete but older record that
    comes later must not bring the key back. It is small: one row per such key.
    ``keep`` writes the keys that both hold and reads them back: they are looked for
    once, and the whole batch is joined with them only if some of its rows are beaten.
    """
    keys = list(keys)
    shape = [F.col(k) for k in keys] + [F.col(latest_by).cast("timestamp").alias(latest_by),
                                       (F.col(LOAD_SEQ) if LOAD_SEQ in batch.columns else F.lit(None)).cast("bigint").alias(LOAD_SEQ)]
    if quarantine is None:
        return batch, batch.where(GONE).select(*shape)
    met = meetings(quarantine, batch, keys, latest_by)
    if keep is not None:
        met = keep(met)
    if keep is None or not met.where("stored_newer").isEmpty():
        batch = without_keys(batch, met.where("stored_newer"), keys)
    left = without_keys(quarantine, met.where(~F.col("stored_newer")), keys)
    return batch, left.unionByName(batch.where(GONE).select(*shape))


def touched_values(target: DataFrame, batch: DataFrame, keys: Sequence[str], part_col: str) -> DataFrame:
    """Partition values an upsert rewrites: the batch's, plus those where its keys live today.

    An update may move a key to another partition (e.g. a corrected event
    date); the old partition must then be rewritten too.
    """
    keys = list(keys)
    moved_from = target.select(*keys, part_col).join(batch.select(*keys).distinct(), on=keys, how="left_semi")
    return batch.select(part_col).union(moved_from.select(part_col)).distinct()


def changed_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows that the target does not hold as they are (load time and order of arrival aside)."""
    other = [c for c in batch.columns if c not in (*keys, LOAD_STAMP, LOAD_SEQ)]
    held = target.select(*[F.col(c).alias(f"_t_{c}") for c in (*keys, *other)])
    same = [F.col(k) == F.col(f"_t_{k}") for k in keys] + [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in other]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return batch.join(held, on, "left_anti")


def upsert_scd2(target: DataFrame, batch_snapshots: DataFrame, entity: str = "warehouse_id",
                start: str = "snapshot_date") -> DataFrame:
    """Upsert daily snapshots into an SCD2 history and re-close the affected intervals.

    For entities present in the batch, the kept history plus the new snapshots
    are re-versioned (``lead`` over the entity's snapshots), so an old
    "current" row gets its end date and a late snapshot between two versions
    splits the interval. Other entities pass through untouched. The window
    is per entity over daily rows: bounded by days, not by fact volume.
    """
    snap_cols = [c for c in batch_snapshots.columns]
    touched = batch_snapshots.select(F.col(entity).alias("_entity")).distinct()
    same = F.col(entity).eqNullSafe(F.col("_entity"))
    history = target.join(touched, same, "left_semi").select(*snap_cols)
    renewed = batch_snapshots.select(F.col(entity).alias("_entity"), F.col(start).alias("_start")).distinct()
    kept = history.join(renewed, same & F.col(start).eqNullSafe(F.col("_start")), "left_anti")
    merged = kept.unionByName(batch_snapshots.select(*snap_cols).distinct())
    reversioned = scd2_versions(merged, entity, start)
    untouched = target.join(touched, same, "left_anti")
    extra = [c for c in target.columns if c not in reversioned.columns]
    for c in extra:
        reversioned = reversioned.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    return untouched.unionByName(reversioned.select(*target.columns))
