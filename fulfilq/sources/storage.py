"""Landing-zone CSV and curated Parquet I/O (S1-S8, S12-S13), incremental scans.

Scale notes
-----------
* Raw CSV is read with a fixed all-string schema: no inference pass, and the
  types do not depend on the Spark version. Lenient casting happens later.
* The incremental scan filters on the ``date=`` folder column, which Spark
  turns into ``PartitionFilters`` (folders below the watermark are never
  listed into tasks), then drops the folder column.
* Partitioned writes use the ``REBALANCE(event_date)`` hint: AQE splits a hot
  day across several tasks/files (no one-task-per-day bottleneck) and merges
  small ones, with no sampling pass over the input (a range partitioner would
  re-run the upstream stage to sample it). Rows are sorted by key within each
  file for tight row-group statistics. ``partitionOverwriteMode=dynamic``
  replaces only the days present in the batch.
* Days of a stored table are written beside it and moved in by a journal
  (``replace_days``): a crash at any point leaves all old days or is finished by
  the next run. A whole flat table is written beside the old one and swapped in.
"""

from __future__ import annotations

import csv
import functools
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fulfilq.schemas import LOAD_SEQ, raw_schema
from fulfilq.session import releases_shuffles, scratch_path

PART_COL = "event_date"
FOLDER_COL = "date"
#: Key sketches of a table's days, below its folder (``sources.key_sketch``).
SKETCHES = "_keys"


# ---------------------------------------------------------------------------
# Landing zone (raw CSV)
# ---------------------------------------------------------------------------
def read_landing(spark: SparkSession, path: str, typed: T.StructType, partitioned: bool = True,
                 watermark: str | None = None, files: Sequence[str] | None = None) -> DataFrame:
    """Read raw CSV (header) as text; optionally only folders ``date >= watermark``, or only ``files``.

    Columns are taken by the header's names: no inference pass (every column
    stays a string until the lenient cast), a missing column becomes NULL and an
    extra one is ignored (``unknown_columns`` lists those). Spark's CSV reader is
    positional, so files are grouped by their header: one reader per distinct
    header, united by name. For partitioned datasets the ``date=YYYY-MM-DD``
    folder value is filtered (``PartitionFilters``: pruned folders are never
    read; ``date=unknown`` always is) and dropped.

    ``load_seq`` numbers the arrival of a record: its file's modification time
    in milliseconds, then a hash of the file's name.
    """
    mark = watermark if partitioned else None
    groups = header_groups(spark, path, mark, files)
    if not groups:
        return spark.createDataFrame([], T.StructType([*raw_schema(typed).fields, T.StructField(LOAD_SEQ, T.LongType())]))
    parts = []
    for header, members in groups.items():
        # each header was read from its files: a file that changes meanwhile fails the read
        reader = spark.read.schema(text_schema(header)).option("header", True).option("enforceSchema", False)
        reader = reader.option("mode", "PERMISSIVE")
        whole = len(groups) == 1 and files is None
        df = reader.csv(path) if whole else reader.option("basePath", path).csv(members)
        df = df.withColumn(LOAD_SEQ, _arrival())
        if mark is not None and FOLDER_COL in df.columns:
            df = df.where(F.col(FOLDER_COL) >= F.lit(mark))
        present = set(df.columns)
        parts.append(df.select(*[F.col(c).cast("string").alias(c) if c in present else F.lit(None).cast("string").alias(c)
                                 for c in raw_schema(typed).names], LOAD_SEQ))
    return functools.reduce(DataFrame.unionByName, parts)


def _arrival():
    modified = F.unix_millis(F.col("_metadata.file_modification_time"))
    name = F.crc32(F.col("_metadata.file_name").cast("binary"))
    return modified * F.lit(1 << 20) + F.pmod(name, F.lit(1 << 20))


class FileInfo(NamedTuple):
    path: str
    size: int
    modified: int


def landed_files(spark: SparkSession, path: str, watermark: str | None = None) -> list[FileInfo]:
    """Data files below ``path`` (metadata only); of ``date=`` folders those from ``watermark`` on."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []

    def walk(folder):
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                key, _, value = name.partition("=")
                if watermark is None or key != FOLDER_COL or value >= watermark:
                    walk(status.getPath())
            elif status.getLen():
                out.append(FileInfo(status.getPath().toString(), status.getLen(), status.getModificationTime()))

    walk(root)
    return sorted(out)


def header_groups(spark: SparkSession, path: str, watermark: str | None = None,
                  files: Sequence[str] | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line. Reads one line of each file (several at a time) and holds a path per file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, ...]:
        p = jvm.org.apache.hadoop.fs.Path(file)
        stream = p.getFileSystem(conf).open(p)
        try:
            codec = codecs.getCodec(p)
            lines = jvm.java.io.BufferedReader(
                jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
            line = lines.readLine()
        finally:
            stream.close()
        return tuple(next(csv.reader([(line or "").lstrip("\ufeff")]), ()))

    names = list(files) if files is not None else [f.path for f in landed_files(spark, path, watermark)]
    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for name, head in zip(names, pool.map(header, names), strict=True):
            if head:
                out.setdefault(head, []).append(name)
    return out


def unknown_columns(spark: SparkSession, path: str, typed: T.StructType, watermark: str | None = None) -> list[str]:
    """Columns in the landed headers that the dataset does not have."""
    return sorted({c for head in header_groups(spark, path, watermark) for c in head} - set(typed.names))


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def write_landing(df: DataFrame, path: str, partitioned: bool = True, date_col: str = PART_COL,
                  compressed: bool = False) -> None:
    """Land a dataset as CSV with header; ``date=`` folders, missing date -> ``unknown``.

    ``compressed``: as ``.csv.gz``. A file is what one task wrote, so reading it in one task is no bottleneck.
    """
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if compressed else {}
    writer = out
    if partitioned:
        writer = out.withColumn(FOLDER_COL, F.coalesce(F.col(date_col), F.lit("unknown")))
        writer = writer.hint("rebalance", FOLDER_COL)
        writer.write.mode("overwrite").option("header", True).options(**options).partitionBy(FOLDER_COL).csv(path)
    else:
        writer.write.mode("overwrite").option("header", True).options(**options).csv(path)


#: Landed text is about this many times its compressed size.
TEXT_PER_COMPRESSED = 7


def text_bytes(files: Sequence[FileInfo]) -> int:
    """About the size of the files' text: what they hold decides on the shuffles, not what they weigh."""
    return sum(f.size * (TEXT_PER_COMPRESSED if f.path.endswith(".gz") else 1) for f in files)


# ---------------------------------------------------------------------------
# Curated / warehouse layer (Parquet)
# ---------------------------------------------------------------------------
def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], part_col: str = PART_COL,
                      mode: str = "overwrite", observe=None) -> None:
    """Parquet partitioned by ``part_col``; only the batch's partitions are replaced.

    ``observe`` = ``(Observation, [metric columns])`` is attached after the
    exchange, where the write executes each row exactly once.
    """
    out = df.hint("rebalance", part_col).sortWithinPartitions(part_col, *keys)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    (out.write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(part_col)
       .parquet(path))


def write_flat(df: DataFrame, path: str, sort_cols: Sequence[str] = (), mode: str = "overwrite",
               observe=None) -> None:
    """Unpartitioned Parquet (no ``coalesce(1)``: one writer task would not scale)."""
    out = df.sortWithinPartitions(*sort_cols) if sort_cols else df
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    out.write.mode(mode).parquet(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Read curated Parquet; a partition folder column is restored from the path."""
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def files(spark: SparkSession, path: str) -> set[str]:
    """Names of the data files or day folders directly under ``path`` (metadata only; nothing there: empty)."""
    if not path_exists(spark, path):
        return set()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {s.getPath().getName() for s in fs.listStatus(p)}
    return {n for n in names if not n.startswith(("_", "."))}


def has_data(spark: SparkSession, path: str) -> bool:
    """A table is there: an empty partitioned write leaves a folder with marker files only."""
    return bool(files(spark, path))


def _fs_paths(spark: SparkSession, target: str):
    jvm = spark.sparkContext._jvm
    tgt = jvm.org.apache.hadoop.fs.Path(target)
    fs = tgt.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, tgt, jvm.org.apache.hadoop.fs.Path(target.rstrip("/") + ".old-swap")


def recover_swap(spark: SparkSession, target: str) -> None:
    """Finish or undo a swap interrupted between its two renames.

    Target missing but the moved-aside copy present: the new copy never
    arrived, so the old one is restored. Both present: the swap completed and
    only the cleanup was lost.
    """
    _, fs, tgt, old = _fs_paths(spark, target)
    if fs.exists(old):
        if fs.exists(tgt):
            fs.delete(old, True)
        else:
            fs.rename(old, tgt)


def swap_in(spark: SparkSession, new_path: str, target: str) -> None:
    """Replace ``target`` by ``new_path`` (rename; the old copy is moved aside, then removed)."""
    recover_swap(spark, target)
    jvm, fs, tgt, old = _fs_paths(spark, target)
    new = jvm.org.apache.hadoop.fs.Path(new_path)
    if not fs.exists(new):  # another file system, or nothing written: leave the old copy where it is
        raise OSError(f"{new_path} is not there, or not on the file system of {target}")
    moved = fs.exists(tgt) and fs.rename(tgt, old)
    if not fs.rename(new, tgt):
        if moved:
            fs.rename(old, tgt)
        raise OSError(f"could not move {new_path} to {target}")
    if moved:
        fs.delete(old, True)


#: Folder of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def day_folder(day, part_col: str = PART_COL) -> str:
    return f"{part_col}={NULL_FOLDER if day is None else day}"


def replace_days(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], days: Sequence | None = None,
                 part_col: str = PART_COL, observe=None, sketch=None) -> None:
    """Make ``df`` the content of ``days`` (values of ``part_col``; ``None``: of the whole table), all or nothing.

    The new days are written beside the table, so ``df`` may read the days it
    replaces. Then a journal that names every move is written by a rename, the
    point from which the change counts; the moves follow, and a crash among them
    is finished by the next ``recover``. A day of ``days`` without rows in ``df`` goes.
    Moves are renames: one file system, one writer per table. A reader that lists
    the table during the moves may miss a day. ``sketch(spark, staged, keys)`` may
    write key sketches of the staged days; they are moved in with their days, and a
    replaced day's old one goes.
    """
    recover(spark, path)
    run = uuid.uuid4().hex
    staged, aside = f"{path.rstrip('/')}.new-{run}", f"{path.rstrip('/')}.old-{run}"
    out = df.hint("rebalance", part_col).sortWithinPartitions(part_col, *keys)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    out.write.partitionBy(part_col).parquet(staged)
    new = {n for n in files(spark, staged) if n.startswith(part_col + "=")}
    old = {n for n in files(spark, path) if n.startswith(part_col + "=")}
    named = old if days is None else {day_folder(d, part_col) for d in days}
    if not new & old <= named:
        raise ValueError(f"rows of days that are not to be replaced: {sorted(new & old - named)}")
    if sketch is not None and new:
        sketch(spark, staged, keys)
    below = {f"{SKETCHES}/{n}" for n in files(spark, f"{staged}/{SKETCHES}")}
    stale = {f"{SKETCHES}/{n}" for n in files(spark, f"{path.rstrip('/')}/{SKETCHES}") & named} - below
    _write_text(spark, _journal(path), json.dumps({
        "staged": staged, "aside": aside, "new": sorted(new | below), "gone": sorted((named & old) - new | stale)}))
    recover(spark, path)


def _journal(path: str) -> str:
    return path.rstrip("/") + ".swap-journal"


def recover(spark: SparkSession, path: str) -> None:
    """Finish the replacement of days, or the swap of a whole table, that a crash interrupted. Run before every use."""
    recover_swap(spark, path)
    text = _read_text(spark, _journal(path))
    if text is None:
        return
    plan, table = json.loads(text), path.rstrip("/")
    for day in plan["new"]:
        if path_exists(spark, f"{plan['staged']}/{day}"):  # not moved in yet
            if path_exists(spark, f"{table}/{day}"):
                _move(spark, f"{table}/{day}", f"{plan['aside']}/{day}")
            _move(spark, f"{plan['staged']}/{day}", f"{table}/{day}")
    for day in plan["gone"]:
        if path_exists(spark, f"{table}/{day}"):
            _move(spark, f"{table}/{day}", f"{plan['aside']}/{day}")
    remove(spark, plan["staged"])
    remove(spark, plan["aside"])
    remove(spark, _journal(path))
    spark.catalog.refreshByPath(path)


def _move(spark: SparkSession, source: str, target: str) -> None:
    jvm, fs, tgt, _ = _fs_paths(spark, target)
    fs.mkdirs(tgt.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(source), tgt):
        raise OSError(f"could not move {source} to {target}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    jvm, fs, tgt, _ = _fs_paths(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, tgt):
        raise OSError(f"could not write {path}")


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm, fs, tgt, _ = _fs_paths(spark, path)
    if not fs.exists(tgt):
        return None
    stream = fs.open(tgt)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def beside(path: str) -> str:
    """A fresh path next to ``path``: the same parent, so the same file system."""
    return f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path (recursive); missing paths are ignored."""
    _, fs, p, _ = _fs_paths(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


@releases_shuffles
def materialize(spark: SparkSession, df: DataFrame, name: str, observe=None) -> DataFrame:
    """Write ``df`` to a fresh path in the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    plan) and decouples the result from the inputs it was computed from.
    """
    path = scratch_path(spark, name)
    out = df.observe(observe[0], *observe[1]) if observe is not None else df
    out.write.mode("overwrite").parquet(path)
    staged = spark.read.parquet(path)
    staged._scratch_path = path  # so the caller can remove it once the data is consumed
    return staged
