"""Schemas, domains and dataset specifications of the fulfillment data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's domains for equal results.
# ---------------------------------------------------------------------------
ORDER_STATUSES = ["PLACED", "PICKED", "PACKED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"]
SHIPPED_STATUSES = ["SHIPPED", "DELIVERED", "RETURNED"]
SHIFTS = ["Morning", "Afternoon", "Night"]
CARRIERS = [
    ("UPS", "National"),
    ("FedEx", "National"),
    ("USPS", "National"),
    ("Amazon Logistics", "Internal"),
    ("OnTrac", "Regional"),
]
PRODUCT_CATEGORY_SLA_HOURS = [
    ("Electronics", 24),
    ("Books", 48),
    ("Apparel", 36),
    ("Home & Kitchen", 48),
    ("Sports", 48),
    ("Toys", 36),
    ("Beauty", 24),
    ("Grocery", 12),
    ("Tools", 48),
    ("Pet Supplies", 36),
]
DEFAULT_SLA_HOURS = 48
DEFECT_TYPES = ["Damaged in transit", "Wrong item", "Missing item", "Late delivery", "Packaging defect"]
ROOT_CAUSES = ["Carrier", "Warehouse", "Supplier", "Customer error"]
REPORT_TYPES = ["RETURN", "DEFECT"]
DIM_DATE_START = "2024-01-01"
DIM_DATE_END = "2027-12-31"
PROCESSING_HOURS_FILL = -1.0
NEAR_CAPACITY_PCT = 95

# ---------------------------------------------------------------------------
# Curated (typed) schemas. Raw CSV is read with every column as string and
# cast leniently to these types (see operators.cleanse.cast_columns).
# ---------------------------------------------------------------------------
S, TS, D, I, DB, B = T.StringType(), T.TimestampType(), T.DateType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

ORDER_EVENTS = T.StructType(
    [
        T.StructField("order_id", S),
        T.StructField("warehouse_id", S),
        T.StructField("product_category", S),
        T.StructField("order_status", S),
        T.StructField("placed_at", TS),
        T.StructField("shipped_at", TS),
        T.StructField("delivered_at", TS),
        T.StructField("shift", S),
        T.StructField("units_ordered", I),
        T.StructField("order_value_usd", DB),
        T.StructField("prime_member", B),
        T.StructField("sla_breach", B),
        T.StructField("processing_hours", DB),
        T.StructField("event_date", D),
    ]
)

SHIPMENT_TRACKING = T.StructType(
    [
        T.StructField("shipment_id", S),
        T.StructField("order_id", S),
        T.StructField("warehouse_id", S),
        T.StructField("carrier", S),
        T.StructField("tracking_number", S),
        T.StructField("shipped_at", TS),
        T.StructField("estimated_delivery_at", TS),
        T.StructField("actual_delivery_at", TS),
        T.StructField("delivery_status", S),
        T.StructField("late_delivery", B),
        T.StructField("event_date", D),
    ]
)

WAREHOUSE_CAPACITY = T.StructType(
    [
        T.StructField("snapshot_date", D),
        T.StructField("warehouse_id", S),
        T.StructField("warehouse_name", S),
        T.StructField("region", S),
        T.StructField("max_daily_capacity", I),
        T.StructField("units_processed", I),
        T.StructField("utilization_pct", DB),
        T.StructField("active_shifts", I),
        T.StructField("headcount", I),
    ]
)

RETURNS_DEFECTS = T.StructType(
    [
        T.StructField("record_id", S),
        T.StructField("order_id", S),
        T.StructField("warehouse_id", S),
        T.StructField("product_category", S),
        T.StructField("report_type", S),
        T.StructField("defect_type", S),
        T.StructField("reported_at", TS),
        T.StructField("units_affected", I),
        T.StructField("refund_issued", B),
        T.StructField("root_cause_category", S),
        T.StructField("event_date", D),
    ]
)

# Warehouse-layer numeric types (the curated layer keeps doubles; loading narrows them).
FACT_DECIMALS = {
    "fact_order": {"order_value_usd": "decimal(10,2)", "processing_hours": "decimal(8,2)"},
    "fact_shipment": {"delivery_delay_hours": "decimal(8,2)"},
    "dim_warehouse": {"utilization_pct": "decimal(5,2)"},
    "fact_returns_defects": {},
}

#: When a row was loaded; never decides which of two records is newer.
LOAD_STAMP = "ingested_at"
#: Order of arrival of a record's file; breaks ties of ``latest_by`` (the later arrival wins).
LOAD_SEQ = "load_seq"
#: Marks a key's newest record as incomplete: the key leaves the table (B2).
GONE = "_gone"

AUDIT_LOG = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("job_name", S),
        T.StructField("target_table", S),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("run_status", S),
        T.StructField("run_ts", TS),
        T.StructField("watermark_date", D),
    ]
)


def raw_schema(typed: T.StructType) -> T.StructType:
    """All-string twin of a typed schema, used to read raw CSV without inference."""
    return T.StructType([T.StructField(f.name, S) for f in typed.fields])


@dataclass(frozen=True)
class DatasetSpec:
    """How one raw dataset is cleansed and loaded."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    latest_by: str | None  # dedup ordering column (latest wins); None = no dedup
    required: tuple[str, ...] = ()
    fill: dict = field(default_factory=dict)
    partitioned: bool = True  # event_date folders on landing and curated layers
    table_partitioned: bool = True  # event_date folders in the warehouse


ORDERS_SPEC = DatasetSpec(
    name="order_events",
    schema=ORDER_EVENTS,
    keys=("order_id",),
    latest_by="placed_at",
    required=("order_id", "placed_at", "order_status"),
    fill={"processing_hours": PROCESSING_HOURS_FILL, "prime_member": False, "sla_breach": False},
)
SHIPMENTS_SPEC = DatasetSpec(
    name="shipment_tracking",
    schema=SHIPMENT_TRACKING,
    keys=("shipment_id",),
    latest_by="shipped_at",
    required=("shipment_id", "order_id", "shipped_at"),
    fill={"late_delivery": False},
)
CAPACITY_SPEC = DatasetSpec(
    name="warehouse_capacity",
    schema=WAREHOUSE_CAPACITY,
    keys=("warehouse_id", "effective_start_date"),
    latest_by=None,
    partitioned=False,
    table_partitioned=False,
)
RETURNS_SPEC = DatasetSpec(
    name="returns_defects",
    schema=RETURNS_DEFECTS,
    keys=("record_id",),
    latest_by="reported_at",
    required=("record_id", "order_id", "report_type"),
    partitioned=False,
)
SPECS = {s.name: s for s in (ORDERS_SPEC, SHIPMENTS_SPEC, CAPACITY_SPEC, RETURNS_SPEC)}
