"""End-to-end batch pipeline: landing CSV -> curated Parquet -> star tables -> marts.

Entry 1 (``run_cleanse``): per dataset one lazy plan (read -> B1..B4 -> write)
with an ``Observation`` for the row count: one job per dataset, no re-scans.
Entry 2 (``run_load``): per target, upsert the curated batch into the star
table and append an audit row (B5, S15). Only the touched days are replaced, by
a journal of moves that a crash cannot leave half done (``storage.replace_days``).
Whole flat tables are written beside the old copy and swapped in. Flat datasets
whose files did not change since the last run are skipped (``sources.ledger``).
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fulfilq.operators import audit, cleanse, dims, marts
from fulfilq.operators.upsert import changed_rows, meetings, newest, settle_quarantine, upsert_scd2, without_keys
from fulfilq.schemas import GONE, LOAD_SEQ, SPECS
from fulfilq.session import configure, input_bytes, releases_shuffles, sized_shuffles
from fulfilq.sources import key_sketch, ledger, storage

log = logging.getLogger(__name__)

TARGETS = {
    "order_events": ("fact_order", ("order_id",)),
    "shipment_tracking": ("fact_shipment", ("shipment_id",)),
    "warehouse_capacity": ("dim_warehouse", ("warehouse_id", "effective_start_date")),
    "returns_defects": ("fact_returns_defects", ("record_id",)),
}


@dataclass(frozen=True)
class Layout:
    """Storage roots. All must be shared storage on a cluster."""

    landing: str
    curated: str
    warehouse: str

    def raw(self, dataset: str) -> str:
        return f"{self.landing.rstrip('/')}/{dataset}"

    def cur(self, dataset: str) -> str:
        return f"{self.curated.rstrip('/')}/{dataset}"

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"

    @property
    def audit(self) -> str:
        return f"{self.warehouse.rstrip('/')}/_audit/pipeline_run_log"

    @property
    def ledger(self) -> str:
        return f"{self.warehouse.rstrip('/')}/_audit/files"


@releases_shuffles
def land(spark: SparkSession, layout: Layout, raw: dict[str, DataFrame]) -> None:
    """Write raw datasets into the landing zone (the simulator's output format, compressed: text is the largest copy of a run)."""
    for name, df in raw.items():
        storage.write_landing(df, layout.raw(name), partitioned=SPECS[name].partitioned, compressed=True)


def _mark(watermark, table: str) -> str | None:
    """The lower bound for one target: of a day for all, or a dict by target table."""
    mark = watermark.get(table) if isinstance(watermark, dict) else watermark
    return None if mark is None else str(mark)


@releases_shuffles
def run_cleanse(spark: SparkSession, layout: Layout, watermark=None) -> dict[str, dict | None]:
    """Raw -> curated for the four datasets.

    ``watermark``: one ``YYYY-MM-DD`` for all datasets, or a dict by target
    table; ``None`` reads everything. A full run makes curated what the landing
    zone holds: days that no longer have rows go. An incremental one upserts by
    key, so a record that came again under another day is there once, and a
    shipment whose newest record is incomplete leaves (the quarantine beside the
    table remembers it), as in a full run.

    Returns per dataset ``{"raw_rows", "rows", "removed", "nulls", "unknown_columns"}``
    (S16, A15, P6: rows read, rows of the batch, incomplete + duplicate rows
    removed, NULLs by raw column after the cast, header columns that the dataset
    does not have), or ``None`` when nothing new landed (S4): no folder from the
    mark on, or a flat dataset's files unchanged. The counts are ``Observation``
    metrics of the write job: no extra scan.
    """
    configure(spark)
    results: dict[str, dict | None] = {}
    for name, spec in SPECS.items():
        path, results[name] = layout.cur(name), None
        storage.recover(spark, path)
        mark = _mark(watermark, TARGETS[name][0]) if spec.partitioned else None
        files = storage.landed_files(spark, layout.raw(name), mark)
        if not files:  # S4: nothing landed, or nothing since the watermark
            continue
        if not spec.partitioned and storage.has_data(spark, path) and ledger.unchanged(spark, layout.ledger, f"raw_{name}", files):
            continue
        raw = storage.read_landing(spark, layout.raw(name), spec.schema, spec.partitioned, mark)
        if raw.isEmpty():
            continue
        unknown = storage.unknown_columns(spark, layout.raw(name), spec.schema, mark)
        if unknown:
            log.warning("%s: columns %s are not part of the dataset and were not read", name, unknown)
        with sized_shuffles(spark, storage.text_bytes(files)):
            raw_obs = Observation(f"{name}_raw")
            typed = cleanse.cast_columns(raw, spec.schema)
            nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.schema.names]
            cur = cleanse.cleanse_increment(name, typed.observe(raw_obs, F.count(F.lit(1)).alias("rows"), *nulls))
            if spec.partitioned:
                n_out = upsert_table(spark, path, cur, spec.keys, True, latest_by=spec.latest_by, unique=True,
                                     whole=mark is None).get("rows")
            else:
                obs = audit.observation(cur, name)
                _replace_flat(spark, cur, path, spec.keys, observe=obs)
                ledger.record(spark, layout.ledger, f"raw_{name}", files)
                n_out = obs[0].get.get("rows")
        got = raw_obs.get
        results[name] = {
            "raw_rows": got["rows"], "rows": n_out, "removed": got["rows"] - n_out,
            "nulls": {c: got[f"null_{c}"] for c in spec.schema.names}, "unknown_columns": unknown,
        }
    return results


def _replace_flat(spark: SparkSession, df: DataFrame, path: str, keys, observe=None) -> None:
    """Write a whole flat table beside the old one, then swap it in."""
    staged = storage.beside(path)
    storage.write_flat(df, staged, sort_cols=keys, observe=observe)
    storage.swap_in(spark, staged, path)


@releases_shuffles
def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys, partitioned: bool,
                 scd2: bool = False, keys_may_move: bool = True, latest_by: str | None = None,
                 unique: bool = False, whole: bool = False, quarantined: DataFrame | None = None,
                 copied: bool = False, may_hold: set[str] | None = None) -> dict:
    """Upsert ``batch`` into the table at ``path`` (created if absent).

    The batch is first reduced to one row per key (``unique``: it already is, as
    every cleanse leaves it). Of a key that table and batch both hold, the batch's
    record wins unless the table's is newer by ``latest_by`` or, at equal times,
    by order of arrival; see ``operators.upsert``. Rows marked ``_gone`` take their
    key out of the table and are remembered in the quarantine beside it.
    ``quarantined``: further such keys, of a table upstream. ``whole``: the batch is
    all there is, the table becomes just that. ``copied``: the batch is a projection of
    stored files, so it is read from them as often as needed and not written once more.
    ``may_hold``: the days that may hold its keys, where they are known (``key_sketch``).

    For partitioned tables only the touched ``event_date`` days (NULL is one of
    them) are read, and their merged rows are written once and moved in by a
    journal. ``keys_may_move=True`` also finds the days where the batch's keys
    live today, so a key whose date changed leaves no stale copy: the key sketches
    beside the days (``sources.key_sketch``) name the days that may hold one, and
    only those days' key, date and order columns are joined. With ``False`` only
    the batch's own days are looked at and no sketches are kept.

    Returns the batch metrics (rows, max partition date) observed while the
    batch was written, so counting costs no extra pass.
    """
    obs = audit.observation(batch, "batch", storage.PART_COL if partitioned else None)
    storage.recover(spark, path)
    batch = batch.distinct() if scd2 else batch if unique else newest(batch, keys, latest_by)
    marked = GONE in batch.columns
    stored = storage.has_data(spark, path)
    if not marked and quarantined is None and (whole or not stored):
        if partitioned:
            storage.replace_days(spark, batch, path, keys, observe=obs, sketch=key_sketch.write if keys_may_move else None)
        else:
            _replace_flat(spark, batch, path, keys, observe=obs)
        return obs[0].get
    if copied and unique and not scd2 and not marked:
        metrics = batch.agg(*obs[1]).first().asDict()
        scratch = []
    else:
        batch = storage.materialize(spark, batch, "batch", observe=obs)
        metrics, scratch = None, [batch._scratch_path]
    rows = batch.where(~F.col(GONE)).drop(GONE) if marked else batch
    if scd2:
        target = storage.read_curated(spark, path).select(*batch.columns)
        merged = upsert_scd2(target, batch.select(*SPECS["warehouse_capacity"].schema.names),
                             "warehouse_id", "snapshot_date")
        merged = dims.to_table(merged.withColumn("ingested_at", F.current_timestamp()), "dim_warehouse")
        _replace_flat(spark, merged.select(*batch.columns), path, keys)
    elif not partitioned:
        target = _target(spark, path, rows)
        hits = meetings(target, batch, keys, latest_by)
        rows = without_keys(rows, hits.where("stored_newer"), keys)
        _replace_flat(spark, without_keys(target, rows, keys).unionByName(rows), path, keys)
    else:
        remembered = None
        if marked:
            old = None if whole or not storage.has_data(spark, _quarantine(path)) else spark.read.parquet(_quarantine(path))

            def keep(met):
                met = storage.materialize(spark, met, "met")
                scratch.append(met._scratch_path)
                return met

            batch, remembered = settle_quarantine(batch, old, keys, latest_by, keep)
        if quarantined is not None:
            more = quarantined.select(*keys, latest_by, LOAD_SEQ).withColumn(GONE, F.lit(True))
            # a quarantined key that the batch brings is one the upstream table holds again
            more = without_keys(more, batch, keys)
            if may_hold is not None:
                may_hold = may_hold | key_sketch.days_that_may_hold(spark, path, more, keys)
            batch = (batch if marked else batch.withColumn(GONE, F.lit(False))).unionByName(more, allowMissingColumns=True)
        scratch += _merge_days(spark, path, batch, keys, latest_by, keys_may_move, whole or not stored, may_hold)
        if remembered is not None and (old is not None or not remembered.isEmpty()):
            _replace_flat(spark, remembered, _quarantine(path), keys)
        elif marked and whole and storage.has_data(spark, _quarantine(path)):
            storage.remove(spark, _quarantine(path))
    spark.catalog.refreshByPath(path)
    # Success: staged copies in the shared scratch folder are no longer needed.
    # (On failure they stay, and a re-run starts from the old days.)
    for s in scratch:
        storage.remove(spark, s)
    return obs[0].get if metrics is None else metrics


def _merge_days(spark, path, batch, keys, latest_by, keys_may_move, alone, may_hold=None) -> list[str]:
    """Replace the touched days of the table by their merge with the batch; returns the scratch tables used."""
    part = storage.PART_COL
    marked = GONE in batch.columns
    sketch = key_sketch.write if keys_may_move else None

    def live(df):
        return df.where(~F.col(GONE)).drop(GONE) if marked else df

    if alone:
        storage.replace_days(spark, live(batch), path, keys, sketch=sketch)
        return []
    target = _target(spark, path, live(batch))
    if keys_may_move:
        if may_hold is None:
            may_hold = key_sketch.days_that_may_hold(spark, path, batch, keys)
        target = target.where(_in_days([None if d == NULL_FOLDER else dt.date.fromisoformat(d) for d in sorted(may_hold)]))
    else:
        target = target.where(_in_days([r[0] for r in batch.select(part).distinct().collect()]))
    hits = storage.materialize(spark, meetings(target, batch, keys, latest_by, [part]), "hits")
    # day values are bounded by the number of days, so they are collected as literals for partition pruning
    met = hits.groupBy(part, "stored_newer").count().collect()
    if any(r["stored_newer"] for r in met):
        batch = without_keys(batch, hits.where("stored_newer"), keys)
    leaving = {r[part] for r in met if not r["stored_newer"]}
    days = leaving | {r[0] for r in live(batch).select(part).distinct().collect()}
    rest = _target(spark, path, live(batch)).where(_in_days(list(days)))
    if leaving:
        rest = without_keys(rest, hits.where(~F.col("stored_newer")), keys)
    if days:
        storage.replace_days(spark, rest.unionByName(live(batch)), path, keys, list(days), sketch=sketch)
    return [hits._scratch_path]


def _check_surrogate_keys(spark: SparkSession, path: str, batch: DataFrame, keys, table: str, partitioned: bool) -> set[str] | None:
    """two business keys with one surrogate key, in the batch or between it and the table, fail the load.

    Returns the days of the stored table that may hold a key of the batch, where they were asked for.
    """
    storage.recover(spark, path)
    stored = may_hold = None
    if storage.has_data(spark, path):
        stored = storage.read_curated(spark, path)
        if partitioned:  # a key that collides sets the same bits, so its day is among these
            may_hold = key_sketch.days_that_may_hold(spark, path, batch, keys)
            stored = stored.where(_in_days([None if d == NULL_FOLDER else dt.date.fromisoformat(d) for d in sorted(may_hold)]))
    key_sketch.check_collisions(stored, batch, keys, table)
    return may_hold


def _target(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored table with the columns of ``like``; one that it lacks (an older table) is NULL."""
    stored = storage.read_curated(spark, path)
    return stored.select(*[F.col(c) if c in stored.columns else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns])


def _quarantine(path: str) -> str:
    """Keys of the table at ``path`` whose newest record is incomplete."""
    return path.rstrip("/") + ".quarantine"


def _in_days(days: list):
    """Rows of these partitions, the NULL partition included where it is listed."""
    day = F.col(storage.PART_COL)
    known = day.isin([d for d in days if d is not None])
    return known | day.isNull() if None in days else known


#: Folder of a NULL partition value.
NULL_FOLDER = storage.NULL_FOLDER


@releases_shuffles
def run_load(spark: SparkSession, layout: Layout, watermark=None,
             job_name: str = "fulfilq_load", keys_may_move: bool = True) -> dict[str, int | None]:
    """Curated -> star tables via upsert, with an audit row per target.

    ``watermark``: one day for all targets or a dict by target table. Rows
    without an event date are always loaded. The seed dimensions are upserted
    by name. A flat dataset (capacity, returns) whose curated files are those of
    the last load is SKIPPED; else only the rows that differ from the target go
    into the upsert, so only their days are rewritten.
    """
    configure(spark)
    load_seeds(spark, layout)
    entries, counts = [], {}
    for name, (table, keys) in TARGETS.items():
        spec = SPECS[name]
        source, path = layout.cur(name), layout.table(table)
        for p in (source, path):
            storage.recover(spark, p)
        flat = None if spec.partitioned else storage.landed_files(spark, source)
        done = flat and storage.has_data(spark, path) and ledger.unchanged(spark, layout.ledger, f"load_{table}", flat)
        if done or not storage.has_data(spark, source):  # loaded already, or nothing curated for this dataset yet
            counts[table] = None
            entries.append({"job_name": job_name, "target_table": table, "rows_loaded": None,
                            "run_status": "SKIPPED"})
            continue
        mark = _mark(watermark, table)
        try:
            cur = storage.read_curated(spark, source)
            day = F.col(storage.PART_COL)
            if spec.partitioned and mark is not None:
                cur = cur.where((day >= F.lit(mark).cast("date")) | day.isNull())
            batch = dims.to_table(cur, table)
            if flat and spec.table_partitioned and storage.has_data(spark, path):
                batch = changed_rows(batch, _target(spark, path, batch), keys)
            left = spark.read.parquet(_quarantine(source)) if storage.has_data(spark, _quarantine(source)) else None
            with sized_shuffles(spark, input_bytes(spark, source)):
                may_hold = _check_surrogate_keys(spark, path, batch, keys, table, spec.table_partitioned)
                m = upsert_table(spark, path, batch, keys, spec.table_partitioned,
                                 scd2=(table == "dim_warehouse"), keys_may_move=keys_may_move,
                                 latest_by=spec.latest_by, unique=True, quarantined=left,
                                 copied=spec.partitioned, may_hold=may_hold)
            if flat:
                ledger.record(spark, layout.ledger, f"load_{table}", flat)
            counts[table] = m.get("rows")
            entries.append({"job_name": job_name, "target_table": table, "rows_loaded": m.get("rows"),
                            "run_status": "SUCCESS",
                            "watermark_date": m.get("max_date") if spec.partitioned else None})
        except Exception:
            entries.append({"job_name": job_name, "target_table": table, "rows_loaded": None,
                            "run_status": "FAILED"})
            audit.append_audit(spark, layout.audit, entries)
            raise
    audit.append_audit(spark, layout.audit, entries)
    return counts


SEEDS = {
    "dim_date": (dims.dim_date, ("date_sk",)),
    "dim_carrier": (dims.dim_carrier, ("carrier_name",)),
    "dim_product_category": (dims.dim_product_category, ("category_name",)),
}


def load_seeds(spark: SparkSession, layout: Layout) -> None:
    """Create the seed dimensions, or add the seed rows a stored one lacks (rows a user added or changed stay)."""
    for table, (seed, key) in SEEDS.items():
        path = layout.table(table)
        storage.recover_swap(spark, path)
        rows = seed(spark)
        if storage.has_data(spark, path):
            stored = storage.read_curated(spark, path)
            missing = rows.join(stored.select(*key), list(key), "left_anti")
            if missing.isEmpty():
                continue
            rows = stored.unionByName(missing.select(*stored.columns))
        _replace_flat(spark, rows, path, key)


def upsert_dimension(spark: SparkSession, layout: Layout, table: str, rows: DataFrame) -> None:
    """Add or change rows of a stored seed dimension by its name key."""
    _, key = SEEDS[table]
    upsert_table(spark, layout.table(table), rows, key, partitioned=False)


def load_star(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Read the star tables back: facts, warehouse versions and seed dimensions (without the order of arrival)."""
    names = [t for t, _ in TARGETS.values()] + list(SEEDS)
    for t in names:
        storage.recover(spark, layout.table(t))
    return {t: storage.read_curated(spark, layout.table(t)).drop(LOAD_SEQ)
            for t in names if storage.has_data(spark, layout.table(t))}


def build_marts(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "daily_ops_scorecard": marts.daily_ops_scorecard(star["fact_order"], star["dim_date"]),
        "shift_performance": marts.shift_performance(star["fact_order"]),
        "carrier_performance": marts.carrier_performance(star["fact_shipment"]),
        "defect_analysis": marts.defect_analysis(star["fact_returns_defects"], star["fact_order"]),
        "warehouse_utilization": marts.warehouse_utilization(star["dim_warehouse"]),
        "executive_summary": marts.executive_summary(star["fact_order"]),
    }


def register_views(star: dict[str, DataFrame], mart_frames: dict[str, DataFrame]) -> None:
    """Expose tables and marts as temp views (``v_<mart>`` like the reference views)."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    for name, df in mart_frames.items():
        df.createOrReplaceTempView(f"v_{name}")


def run(spark: SparkSession, layout: Layout, watermark=None, overlap_days: int = 0) -> dict[str, DataFrame]:
    """Cleanse, load and expose the marts; returns the (lazy) mart DataFrames.

    ``watermark``: ``None`` = full load; a ``YYYY-MM-DD`` day = only folders from
    that day on; ``"auto"`` = each target resumes from its own mark in the audit
    log, ``overlap_days`` earlier; a target without one is loaded in full.
    """
    if watermark == "auto":
        watermark = audit.resolve_watermarks(spark, layout.audit, [t for t, _ in TARGETS.values()], overlap_days)
    run_cleanse(spark, layout, watermark)
    run_load(spark, layout, watermark)
    star = load_star(spark, layout)
    m = build_marts(star)
    register_views(star, m)
    return m


def validate(spark: SparkSession, layout: Layout, expected_warehouses: list[str]) -> DataFrame:
    """Run the quality suite (Q1-Q32) over the raw landing datasets; one row per check."""
    from fulfilq.operators import quality

    configure(spark)
    raw = {name: cleanse.cast_columns(storage.read_landing(spark, layout.raw(name), spec.schema, spec.partitioned),
                                      spec.schema).drop(LOAD_SEQ)
           for name, spec in SPECS.items()}
    expected = spark.createDataFrame([(w,) for w in expected_warehouses], "warehouse_id string")
    orders = raw["order_events"]
    return (quality.quality_orders(orders)
            .unionByName(quality.quality_shipments(raw["shipment_tracking"], orders))
            .unionByName(quality.quality_capacity(raw["warehouse_capacity"], expected))
            .unionByName(quality.quality_returns(raw["returns_defects"], orders)))


def smoke(spark: SparkSession, layout: Layout) -> DataFrame:
    """Q33 over the curated files just written: rows, load stamp and unique key of each dataset."""
    from fulfilq.operators import quality

    stored = {n: storage.read_curated(spark, layout.cur(n)) for n in SPECS if storage.has_data(spark, layout.cur(n))}
    return quality.curated_smoke(stored, {n: list(SPECS[n].keys) for n in stored})


def write_marts(star: dict[str, DataFrame], path: str) -> None:
    """Persist each mart as Parquet under ``path/<mart>`` (small outputs: one global aggregate grain each)."""
    for name, df in build_marts(star).items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
