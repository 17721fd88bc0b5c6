"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (operator 13).

The ring has ``CELLS`` places. A shard stands on ``NODES`` of them (its virtual
nodes; a place already taken by a lower shard is left out, so one more shard
moves no other), and a row hashes by its key to a place. Going clockwise, a row
goes to the first shard that still has room. Room is ``(1 + slack)`` of the mean;
``slack=0`` makes counts at most one apart (the first shards take the odd rows).

Who is turned away is decided on counts alone, hop by hop: the rows of a place
try the next virtual node, a shard takes its places in a fixed hashed order until
it is full, and what is left goes one node further. The driver holds one count
per place (``CELLS`` numbers whatever the data), and the plan is at most a few
stretches of ranks per place, so it may be broadcast.

A row's rank within its place follows (hash of its content, content). Ranks are
numbered in two levels, and equal rows also by the partition they were written
in, so neither a hot key nor a row repeated without end is one task's work.
Slots are gapless per shard: the base of a stretch plus the rank within it.

Nulls in key or content are values like others. Equal rows are interchangeable.
No rows: no result. Columns of ``rows`` are kept; ``shard``, ``slot`` and names
starting with ``__ring`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulfilq.llm.common import materialize, mix64

CELLS, NODES = 1 << 16, 128
#: Parts of a place that are numbered on their own.
PARTS = 1024


def virtual_nodes(n_shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(places, shards) of the virtual nodes in ring order."""
    owner: dict[int, int] = {}
    for shard in range(n_shards):
        for i in range(nodes):
            owner.setdefault(xxhash.xxh64_intdigest(f"{shard}:{i}") % CELLS, shard)
    places = np.array(sorted(owner), np.int64)
    return places, np.array([owner[p] for p in places.tolist()], np.int64)


def room(total: int, n_shards: int, slack: float = 0.0) -> np.ndarray:
    """Rows that each shard may take."""
    if slack > 0:
        return np.full(n_shards, int(np.ceil((1 + slack) * total / n_shards)), np.int64)
    return total // n_shards + (np.arange(n_shards) < total % n_shards).astype(np.int64)


def plan(counts: np.ndarray, n_shards: int, slack: float = 0.0, nodes: int = NODES) -> dict[str, np.ndarray]:
    """Stretches of ranks: rows ``low <= rank < high`` of ``cell`` go to ``shard``, the first of them to slot ``base``."""
    places, owner = virtual_nodes(n_shards, nodes)
    left = room(int(counts.sum()), n_shards, slack)
    taken = np.zeros(n_shards, np.int64)
    cell = np.flatnonzero(counts)
    cell = cell[np.argsort(mix64(cell.astype(np.uint64) + np.uint64(1)), kind="stable")]  # the order in which a shard takes
    rest, done = counts[cell].astype(np.int64), np.zeros(len(cell), np.int64)
    node = np.searchsorted(places, cell) % len(places)
    found = []
    for _ in range(len(places)):
        if not len(cell):
            break
        shard = owner[node]
        order = np.argsort(shard, kind="stable")
        s, r = shard[order], rest[order]
        before = np.cumsum(r) - r
        start = np.searchsorted(s, np.arange(n_shards))
        before -= before[np.minimum(start, len(s) - 1)][s]
        take = np.clip(left[s] - before, 0, r)
        got = take > 0
        o, t = order[got], take[got]
        found.append(np.stack([cell[o], done[o], done[o] + t, s[got], taken[s[got]] + before[got]]))
        rest[o] -= t
        done[o] += t
        n = np.bincount(s, weights=take, minlength=n_shards).astype(np.int64)
        left -= n
        taken += n
        open_ = rest > 0
        cell, rest, done, node = cell[open_], rest[open_], done[open_], (node[open_] + 1) % len(places)
    out = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
    return dict(zip(("__ring_cell", "__ring_low", "__ring_high", "shard", "__ring_base"), out, strict=True))


def place(key: Sequence[str]):
    """Place of a row on the ring."""
    return F.pmod(F.xxhash64(*key), F.lit(CELLS))


def assign(rows: DataFrame, key: Sequence[str], n_shards: int, slack: float = 0.0, content: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (both long, from 0).

    ``key``: columns that place a row. ``content``: columns that order the rows of
    one place (default all); rows equal in them count as equal.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot") and not c.startswith("__ring")]
    content = list(content) or kept
    cell, part, digest, salt = "__ring_cell", "__ring_part", "__ring_hash", "__ring_salt"
    # written once: the partition that a row was written from is part of its number
    spread = materialize(
        rows.select(*kept).withColumns(
            {cell: place(key), digest: F.xxhash64(*content), salt: F.spark_partition_id()}
        ).withColumn(part, F.pmod(F.col(digest), F.lit(PARTS))),
        "ring",
    )
    fine = spread.groupBy(cell, part, digest, salt).agg(F.count("*").alias("n"))
    inner = Window.partitionBy(cell, part).orderBy(digest, salt).rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn("__ring_fine", F.coalesce(F.sum("n").over(inner), F.lit(0))).drop("n")
    parts = spread.groupBy(cell, part).agg(F.count("*").alias("n"))
    outer = Window.partitionBy(cell).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumn("__ring_part_base", F.coalesce(F.sum("n").over(outer), F.lit(0))), "ring-parts")
    # one number per place of the ring
    per_cell = parts.groupBy(cell).agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[per_cell.column(cell).to_numpy()] = per_cell.column("n").to_numpy()
    table = pa.table(plan(counts, n_shards, slack))
    stretches = F.broadcast(rows.sparkSession.createDataFrame(table))
    each = Window.partitionBy(cell, part, digest, salt).orderBy(*content)
    ranked = (
        spread.withColumn("__ring_each", F.row_number().over(each) - 1)
        .join(fine, [cell, part, digest, salt])
        .join(parts.drop("n"), [cell, part])
        .withColumn("__ring_rank", F.col("__ring_part_base") + F.col("__ring_fine") + F.col("__ring_each"))
    )
    s = stretches.withColumnRenamed(cell, "__ring_at")
    hit = (F.col(cell) == F.col("__ring_at")) & (F.col("__ring_rank") >= F.col("__ring_low")) & (F.col("__ring_rank") < F.col("__ring_high"))
    slot = F.col("__ring_base") + F.col("__ring_rank") - F.col("__ring_low")
    return ranked.join(s, hit).select(*kept, "shard", slot.alias("slot"))
