"""Dimensions (D1-D4) and fact projections of the star schema.

Dimensions are small and fixed in size (dates, carriers, categories) or grow
only with warehouses x days (SCD2 warehouse versions), so joins against
``dim_date`` / ``dim_carrier`` / ``dim_product_category`` are broadcast; their
size is bounded by construction (at most one row per calendar day / seed row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fulfilq.functions import date_key, surrogate_key
from fulfilq.schemas import (
    CARRIERS,
    DIM_DATE_END,
    DIM_DATE_START,
    FACT_DECIMALS,
    GONE,
    LOAD_SEQ,
    PRODUCT_CATEGORY_SLA_HOURS,
)

FACT_ORDER_COLUMNS = [
    "order_sk", "order_id", "warehouse_id", "product_category", "order_status", "placed_at", "shipped_at",
    "delivered_at", "shift", "units_ordered", "order_value_usd", "prime_member", "sla_breach",
    "processing_hours", "order_day_of_week", "is_weekend", "fulfillment_speed_tier", "event_date", "ingested_at",
]
FACT_SHIPMENT_COLUMNS = [
    "shipment_sk", "shipment_id", "order_id", "warehouse_id", "carrier", "tracking_number", "shipped_at",
    "estimated_delivery_at", "actual_delivery_at", "delivery_status", "late_delivery", "delivery_delay_hours",
    "event_date", "ingested_at",
]
DIM_WAREHOUSE_COLUMNS = [
    "warehouse_sk", "warehouse_id", "warehouse_name", "region", "max_daily_capacity", "units_processed",
    "utilization_pct", "active_shifts", "headcount", "snapshot_date", "effective_start_date",
    "effective_end_date", "is_current", "ingested_at",
]
FACT_RETURNS_COLUMNS = [
    "record_sk", "record_id", "order_id", "warehouse_id", "product_category", "report_type", "defect_type",
    "reported_at", "units_affected", "refund_issued", "root_cause_category", "event_date", "ingested_at",
]
TABLE_COLUMNS = {
    "fact_order": (FACT_ORDER_COLUMNS, ("order_id",)),
    "fact_shipment": (FACT_SHIPMENT_COLUMNS, ("shipment_id",)),
    "dim_warehouse": (DIM_WAREHOUSE_COLUMNS, ("warehouse_id", "effective_start_date")),
    "fact_returns_defects": (FACT_RETURNS_COLUMNS, ("record_id",)),
}


def dim_date(spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END) -> DataFrame:
    """One row per calendar day in ``[start, end]`` (1,461 rows for 2024-2027)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day")))
        .alias("full_date")
    )
    return dim_date_of(days)


def dim_date_of(days: DataFrame, col: str = "full_date") -> DataFrame:
    """Calendar attributes for a DataFrame holding one date column."""
    d = F.col(col)
    dow = F.dayofweek(d)
    return days.select(
        date_key(d).alias("date_sk"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        dow.alias("day_of_week_num"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        dow.isin(1, 7).alias("is_weekend"),
        (~dow.isin(1, 7)).alias("is_weekday"),
    )


def dim_carrier(spark: SparkSession) -> DataFrame:
    """Seed carriers, keyed by name (re-loading the seed is idempotent)."""
    schema = T.StructType([T.StructField("carrier_name", T.StringType()),
                           T.StructField("carrier_type", T.StringType())])
    df = spark.createDataFrame(CARRIERS, schema)
    return df.select(surrogate_key("carrier_name").alias("carrier_sk"), "carrier_name", "carrier_type")


def dim_product_category(spark: SparkSession) -> DataFrame:
    """D3: seed product categories with their SLA hours."""
    schema = T.StructType([T.StructField("category_name", T.StringType()),
                           T.StructField("sla_hours", T.IntegerType())])
    df = spark.createDataFrame(PRODUCT_CATEGORY_SLA_HOURS, schema)
    return df.select(surrogate_key("category_name").alias("category_sk"), "category_name", "sla_hours")


def to_table(curated: DataFrame, table: str) -> DataFrame:
    """Project a curated dataset onto a star-schema table by name (P14, X10), in one projection.

    Adds the deterministic surrogate key and narrows doubles to the table's
    DECIMAL types; a missing ``ingested_at`` becomes NULL so the same function
    serves oracle-compared (unstamped) plans. The order of arrival and the mark
    of incomplete records pass through where the dataset has them.
    """
    columns, keys = TABLE_COLUMNS[table]
    casts = FACT_DECIMALS[table]
    present = set(curated.columns)
    exprs = []
    for c in columns:
        if c == columns[0]:
            e = surrogate_key(*keys)
        elif c == "ingested_at" and c not in present:
            e = F.lit(None).cast("timestamp")
        elif c == "snapshot_date" and c not in present:
            e = F.col("effective_start_date")
        else:
            e = F.col(c)
        exprs.append((e.cast(casts[c]) if c in casts else e).alias(c))
    return curated.select(*exprs, *[c for c in (LOAD_SEQ, GONE) if c in present])
