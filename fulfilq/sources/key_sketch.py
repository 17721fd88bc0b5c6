"""Key sketches: which days of a stored table can hold a key, without reading the table's keys.

Every day of a partitioned table has a blocked Bloom filter of its keys' hashes,
kept under ``_keys`` in the table's folder (hidden from its readers) and moved
in with the day by the same journal. A block is 32,768 bits for about 1,024
keys, each key sets ``BITS`` bits in one block: 4 bytes a key, and one key in
about 200,000 is taken for present by mistake. A mistake costs a look at that
day's key columns; a key that is there is never missed. A sketch names the data
files it was made of, so days that something else rewrote, and days without a
sketch, count as holding every key.

The hash is the surrogate key's: two business keys with the same one meet in
the same bits, so ``collisions`` needs to look at the named days only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fulfilq.functions import expr
from fulfilq.sources import storage

FOLDER = storage.SKETCHES
BLOCK_BITS = 1 << 15
KEYS_PER_BLOCK = 1 << 10
BITS = 8


class KeyCollision(ValueError):
    """Two business keys have one surrogate key."""


def key_hash(keys: Sequence[str]) -> Column:
    return expr.surrogate_key(*keys)


def _has_all(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def _walk(h: Column) -> tuple[Column, Column]:
    """Place of the key's first bit in its block and the step to each next one: double hashing on a second hash."""
    second = F.xxhash64(h, F.lit(1))
    step = F.shiftright(second, 32).bitwiseOR(F.lit(1))
    return F.pmod(second, F.lit(BLOCK_BITS)), F.pmod(step, F.lit(BLOCK_BITS))


def fingerprints(spark: SparkSession, path: str, part_col: str = storage.PART_COL) -> dict[str, int]:
    """Per day folder a hash of its data files' names (metadata only)."""
    names: dict[str, list[str]] = {}
    for f in storage.landed_files(spark, path):
        folder, name = f.path.rsplit("/", 2)[1:]
        if folder.startswith(part_col + "="):
            names.setdefault(folder, []).append(name)
    return {folder: zlib.crc32("\n".join(sorted(n)).encode()) for folder, n in names.items()}


def write(spark: SparkSession, path: str, keys: Sequence[str], part_col: str = storage.PART_COL) -> None:
    """Sketch all days of the table at ``path`` (days just staged): reads their key columns only."""
    rows = spark.read.parquet(path).where(_has_all(keys)).select(F.col(part_col).alias("day"), key_hash(keys).alias("h"))
    prints = fingerprints(spark, path, part_col)
    sizes = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per day
    if not sizes:
        return
    shape = []
    for i, r in enumerate(sizes):
        folder = storage.day_folder(r["day"], part_col)
        blocks = 1 << max(0, (r["n"] - 1) // KEYS_PER_BLOCK).bit_length()
        shape.append((i, r["day"], folder.split("=", 1)[1], blocks, prints[folder]))
    # one row per day: bounded by the calendar
    days = F.broadcast(spark.createDataFrame(
        shape, f"place int, d {rows.schema['day'].dataType.simpleString()}, folder string, blocks bigint, made_of bigint"))
    first, step = _walk(F.col("h"))
    placed = rows.join(days, F.col("day").eqNullSafe(F.col("d"))).select(
        "place", F.pmod("h", F.col("blocks")).alias("block"), first.cast("int").alias("first"), step.cast("int").alias("step"))
    # a key is one narrow row of the shuffle; its bits are set where its block is gathered
    gathered = placed.repartition("place", "block").sortWithinPartitions("place", "block")
    filled = gathered.mapInArrow(_fill_blocks, "place int, block bigint, bits array<bigint>")
    out = filled.join(days, "place").select("blocks", "made_of", "block", "bits", F.col("folder").alias(part_col))
    out.hint("rebalance", part_col).write.partitionBy(part_col).parquet(f"{path.rstrip('/')}/{FOLDER}")


#: Blocks whose bits are spread out at once (32 kB each).
BLOCKS_AT_ONCE = 256


def _fill_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block with its bits as 64-bit words, of keys sorted by block; holds a few blocks, and one open between batches."""
    open_key, open_bits = None, None

    def rows(keys, flags):
        words = np.packbits(flags, axis=1, bitorder="little").view("<i8")
        flat = pa.array(words.ravel(), pa.int64())
        ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * words.shape[1], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0], pa.int32()), pa.array(keys[:, 1], pa.int64()), pa.ListArray.from_arrays(ends, flat)],
            ["place", "block", "bits"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "block")], axis=1)
        first, step = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "step"))
        starts = np.concatenate([[0], 1 + np.flatnonzero((key[1:] != key[:-1]).any(axis=1))])
        for lo in range(0, len(starts), BLOCKS_AT_ONCE):
            some = starts[lo:lo + BLOCKS_AT_ONCE]
            end = starts[lo + len(some)] if lo + len(some) < len(starts) else len(key)
            of = np.repeat(np.arange(len(some)), np.diff(np.append(some, end)))
            flags = np.zeros((len(some), BLOCK_BITS), dtype=bool)
            for i in range(BITS):
                flags[of, (first[some[0]:end] + i * step[some[0]:end]) % BLOCK_BITS] = True
            keys = key[some]
            if open_key is not None:
                if (keys[0] == open_key).all():
                    flags[0] |= open_bits
                else:
                    yield rows(open_key[None], open_bits[None])
            open_key, open_bits = keys[-1], flags[-1].copy()
            if len(some) > 1:
                yield rows(keys[:-1], flags[:-1])
    if open_key is not None:
        yield rows(open_key[None], open_bits[None])


def _is_set(bits: Column, place: Column) -> Column:
    return F.getbit(F.get(bits, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1


def days_that_may_hold(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                       part_col: str = storage.PART_COL) -> set[str]:
    """Folder values of the days of the table at ``path`` in which a key of ``batch`` may be (as text; NULL's is its folder name).

    The batch's hashes meet the blocks they would be in, once per size of sketch;
    every (key, day) costs a few bits read inside the join, and one name per day
    comes to the driver.
    """
    now = fingerprints(spark, path, part_col)
    sketches = f"{path.rstrip('/')}/{FOLDER}"
    if not storage.files(spark, sketches):
        return {f.split("=", 1)[1] for f in now}
    # the folder's value as text, not as Spark would guess its type (NULL's folder is one of them)
    folder = F.regexp_extract("_metadata.file_path", f"/{part_col}=([^/]*)/[^/]*$", 1)
    sketch = spark.read.parquet(sketches).select(folder.alias("day"), "blocks", "made_of", "block", "bits")
    known = sketch.select("day", "blocks", "made_of").distinct().collect()  # one row per day
    valid = {r["day"] for r in known if now.get(f"{part_col}={r['day']}") == r["made_of"]}
    out = {f.split("=", 1)[1] for f in now} - valid
    if not valid:
        return out
    levels = sorted({r["blocks"] for r in known if r["day"] in valid})
    h = batch.where(_has_all(keys)).select(key_hash(keys).alias("h"))
    first, step = _walk(F.col("h"))
    at = h.select("h", first.cast("int").alias("first"), step.cast("int").alias("step"),
                  F.explode(F.array(*[F.lit(n).cast("bigint") for n in levels])).alias("blocks"))
    at = at.select("blocks", F.pmod("h", F.col("blocks")).alias("block"), "first", "step")
    on = (F.col("s.blocks") == F.col("k.blocks")) & (F.col("s.block") == F.col("k.block"))
    for i in range(BITS):  # every (key, day) is looked at: the key's hash is taken before, most looks end at the first bit
        on = on & _is_set(F.col("s.bits"), (F.col("k.first") + F.lit(i) * F.col("k.step")).bitwiseAND(F.lit(BLOCK_BITS - 1)))
    held = sketch.where(F.col("day").isin(sorted(valid))).alias("s").join(at.alias("k"), on, "left_semi")
    return out | {r["day"] for r in held.select("day").distinct().collect()}


def collisions(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of different business keys with one surrogate key: within ``batch``, and between it and ``stored``.

    ``stored`` may be cut down to the days that may hold a key of the batch.
    """
    def narrow(df):
        return df.where(_has_all(keys)).select(key_hash(keys).alias("sk"), F.struct(*[F.col(k).cast("string") for k in keys]).alias("key"))

    ours = narrow(batch)
    # only hashes that come twice need their keys compared: of a batch with one row per key next to none.
    # A key holds one value of "key" unless it collides, so the extremes of a group show it: no lists, hot keys pre-aggregated
    twice = ours.groupBy("sk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sk")
    found = ours.join(twice, "sk", "left_semi").groupBy("sk").agg(
        F.min("key").alias("a"), F.max("key").alias("b")).where(F.col("a") != F.col("b"))
    if stored is None:
        return found
    met = narrow(stored).alias("t").join(ours.distinct().alias("u"), (F.col("t.sk") == F.col("u.sk")) & (F.col("t.key") != F.col("u.key")))
    return found.unionByName(met.select(F.col("t.sk").alias("sk"), F.col("t.key").alias("a"), F.col("u.key").alias("b")))


def check_collisions(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], table: str) -> None:
    """fail the load if two business keys have one surrogate key."""
    some = collisions(stored, batch, keys).limit(5).collect()
    if some:
        pairs = "; ".join(f"{tuple(r['a'])} and {tuple(r['b'])}: {r['sk']}" for r in some)
        raise KeyCollision(f"{table}: different business keys have one surrogate key: {pairs}")
