"""fulfilq — warehouse-fulfillment analytics as composable Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function unless noted):

* ``fulfilq.sources``    raw CSV / curated Parquet I/O, incremental scans, fixtures
* ``fulfilq.functions``  column expressions (rates, rounding, tiers, shifts, delays)
* ``fulfilq.operators``  cleanse, dedup, SCD2, dimensions, upsert, quality, marts
* ``fulfilq.plans``      end-to-end batch pipeline (raw -> curated -> star -> marts)
* ``fulfilq.streaming``  file-stream wrapper that upserts each micro-batch
"""

from fulfilq.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
