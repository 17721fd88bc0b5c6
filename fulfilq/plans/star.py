"""Lazy composition: raw datasets -> curated datasets -> star schema tables.

Nothing here touches storage; every function returns DataFrames whose plans
Catalyst optimizes end to end (column pruning reaches the source scans).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fulfilq.operators import cleanse, dims
from fulfilq.plans.lazy import Lazy
from fulfilq.sources import fixtures


def curate(raw: Mapping[str, DataFrame], stamp: bool = True) -> Mapping[str, DataFrame]:
    """B1-B4 over whichever raw datasets are given (each built on first access)."""
    return Lazy({name: (lambda n=name: cleanse.CLEANSERS[n](raw[n], stamp=stamp)) for name in raw})


def star(spark: SparkSession, curated: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """Star-schema tables from curated datasets plus the seed dimensions (built on first access)."""
    out = {
        "dim_date": lambda: dims.dim_date(spark),
        "dim_carrier": lambda: dims.dim_carrier(spark),
        "dim_product_category": lambda: dims.dim_product_category(spark),
    }
    mapping = {
        "order_events": "fact_order",
        "shipment_tracking": "fact_shipment",
        "warehouse_capacity": "dim_warehouse",
        "returns_defects": "fact_returns_defects",
    }
    for name in curated:
        out[mapping[name]] = lambda n=name: dims.to_table(curated[n], mapping[n])
    return Lazy(out)


def fixture_raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return fixtures.raw_datasets(spark, sf_dir)


def fixture_curated(spark: SparkSession, sf_dir: str, stamp: bool = False) -> Mapping[str, DataFrame]:
    return curate(fixture_raw(spark, sf_dir), stamp=stamp)


def fixture_star(spark: SparkSession, sf_dir: str, stamp: bool = False) -> Mapping[str, DataFrame]:
    """The star schema built from the driver's tables through the full cleanse path."""
    return star(spark, fixture_curated(spark, sf_dir, stamp=stamp))
