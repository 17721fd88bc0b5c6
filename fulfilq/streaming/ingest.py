"""Incremental ingestion as a Structured Streaming file source.

New CSV files landing under a dataset's folder are picked up by a file stream
that sees names only (the content column is pruned); each micro-batch reads its
files by their headers, cleanses them (B1-B4) and upserts them into the star
table inside ``foreachBatch``. The upsert is idempotent, so a micro-batch
replayed after a failure (the checkpoint records which files were committed)
leaves the same table: effectively exactly-once. The newest record of a key wins,
at equal times the one whose file arrived later, whichever micro-batch brings
it, and a shipment whose newest record is incomplete is out (the quarantine
remembers it): the table does not depend on where the stream is cut and equals
that of a batch run over all files. ``availableNow`` processes all pending files
in bounded batches and stops, the streaming form of the reference's scheduled
batch with a high-water mark (T1/T2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fulfilq.operators import cleanse, dims
from fulfilq.plans.pipeline import TARGETS, Layout, upsert_table
from fulfilq.schemas import SPECS
from fulfilq.session import configure
from fulfilq.sources import storage


#: Columns of Spark's file listing source; only ``path`` is ever read.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landing_stream(spark: SparkSession, layout: Layout, dataset: str, max_files: int = 1000) -> DataFrame:
    """A streaming DataFrame of the paths of new files in the dataset's landing folder, at most ``max_files`` a batch."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files)
            .load(layout.raw(dataset))
            .select("path"))


def start_ingest(spark: SparkSession, layout: Layout, dataset: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None, max_files: int = 1000,
                 keys_may_move: bool = True) -> StreamingQuery:
    """Start the stream -> cleanse -> upsert query for one dataset.

    ``max_files``: files of one micro-batch. ``keys_may_move=False`` states that
    a key never changes its day, which spares the search for its old one.
    """
    configure(spark)
    spec = SPECS[dataset]
    table, keys = TARGETS[dataset]

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        files = [r["path"] for r in batch.collect()]  # at most max_files
        raw = storage.read_landing(session, layout.raw(dataset), spec.schema, spec.partitioned, files=files)
        cur = cleanse.cleanse_increment(dataset, raw)
        upsert_table(session, layout.table(table), dims.to_table(cur, table), keys, spec.table_partitioned,
                     scd2=(table == "dim_warehouse"), keys_may_move=keys_may_move, latest_by=spec.latest_by, unique=True)

    writer = landing_stream(spark, layout, dataset, max_files).writeStream.foreachBatch(load_batch) \
        .option("checkpointLocation", checkpoint).queryName(f"ingest_{dataset}")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, layout: Layout, checkpoint_root: str) -> None:
    """Process every pending landing file of all four datasets, then return."""
    for dataset in SPECS:
        q = start_ingest(spark, layout, dataset, f"{checkpoint_root.rstrip('/')}/{dataset}")
        q.awaitTermination()
