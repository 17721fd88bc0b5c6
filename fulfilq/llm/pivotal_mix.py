"""Mixing sources to target weights by pivotal dependent rounding (operator 8).

Each source gets a share of all words by its weight, at most ``MOST`` times its
own (the excess goes to the others by weight). A document's expected copies are
target / source size; the whole part is taken, the fractional parts are
rounded together: units are paired, word mass moves between the two in a random
direction until one of them is integral, the other goes on to the next pair, so
the words taken stay at the target. Units are folded in blocks of about
``FANOUT`` of one source; the one unit left of each block goes up a reduction
tree (blocks of ``FANOUT`` residuals) until a source has a single one, which is
rounded to the nearer side. A block is folded by falling size, and the mass of
a unit keeps the direction drawn for it until it is integral; where the rest of
the block has room for one direction only, that one is taken. So what stays
open at the end is a small unit, and only the last units of a block deviate
from their copy probability. Every choice is a hash of the seed and the
document: reruns agree.

DataFrame functions only. Null text: size 0, no words taken. A null source is a
source of its own, last in order. Repeated rows are units of their own. No
rows: no result rows. Only id, source and size travel; texts do not. Very long
texts are counted whole. ``mixed`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulfilq.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MOST = 3
FANOUT = 512
#: Equal rows beyond which a key's texts are numbered in parts.
HOT = 1024
SEED = 20_11


def units(docs: DataFrame) -> DataFrame:
    """id (doc_id, fingerprint of the text), source, size in words: one row per row of ``docs``."""
    return docs.select(
        F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("row")).alias("id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )


def numbered(u: DataFrame) -> DataFrame:
    """Adds ``nth`` (1, 2, ...) among equal rows, so that a hot repeated row is many distinct units."""
    step = 1024
    n = u.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    n = n.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / step))))
    nth = F.explode(F.sequence(F.col("part") * step + 1, F.least("n", (F.col("part") + 1) * step)))
    return n.select("id", "source", "size", nth.alias("nth"))


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size, ...): one row per source."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("cap")
    rank = F.row_number().over(in_order) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumns({"weight": w, "cap": (most * F.col("source_size")).cast("double")})
    # fill by weight: sources in the order in which they reach their cap
    fill = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns(
        {
            "k": F.row_number().over(fill),
            "all_size": F.sum("source_size").over(every),
            "capped": F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "open": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    s = s.withColumn("level", (F.col("all_size") - F.col("capped")) / F.col("open"))
    holds = F.when(F.col("level") <= cap / F.col("weight") * (1 + 1e-12), F.struct("k", "level"))
    s = s.withColumn("fill", F.min(holds).over(every)["level"])
    return s.select(*sizes.columns, F.least(cap, F.col("weight") * F.col("fill")).alias("target"))


def uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(2**53))


def fold(members: Column) -> Column:
    """Folds an array of units (id, nth, size, p, u): (open, unit, done), done with the copies of the decided ones.

    Where the rest of the block has room for one direction of a unit only, that one is taken; where it
    has for neither, the one that lacks less.
    """

    def unit(x, p):
        return F.struct(x["id"].alias("id"), x["nth"].alias("nth"), x["size"].alias("size"), p.alias("p"), x["u"].alias("u"))

    def decided(x, one):
        return F.struct(x["id"].alias("id"), x["nth"].alias("nth"), F.when(one, 1).otherwise(0).alias("extra"))

    def state(is_open, x, way, gives, takes, done):
        return F.struct(
            is_open.alias("open"), x.alias("unit"), way.alias("way"), gives.alias("gives"), takes.alias("takes"), done.alias("done")
        )

    def step(acc, b):
        a, was = acc["unit"], acc["way"]
        a_up, a_down = (1 - a["p"]) * a["size"], a["p"] * a["size"]
        b_up, b_down = (1 - b["p"]) * b["size"], b["p"] * b["size"]
        rise, sink = F.least(a_up, b_down), F.least(a_down, b_up)
        drawn = F.when(b["u"] * (rise + sink) < sink, 1).otherwise(-1)
        can_rise, can_sink = a_up <= acc["gives"], a_down <= acc["takes"]
        lacks_less = a_up - acc["gives"] < a_down - acc["takes"]
        drawn = F.when(can_rise & can_sink, drawn).otherwise(F.when(lacks_less, 1).otherwise(-1))
        way = F.when(was != 0, was).otherwise(drawn)
        up = way > 0
        moved = way * F.when(up, rise).otherwise(sink)
        a_done = F.when(up, a_up <= b_down).otherwise(a_down <= b_up)
        b_done = F.when(up, b_down <= a_up).otherwise(b_up <= a_down)
        done = F.concat(
            acc["done"],
            F.when(a_done, F.array(decided(a, up))).otherwise(F.slice(F.array(decided(a, up)), 1, 0)),
            F.when(b_done, F.array(decided(b, ~up))).otherwise(F.slice(F.array(decided(b, ~up)), 1, 0)),
        )
        rest_a, rest_b = unit(a, a["p"] + moved / a["size"]), unit(b, b["p"] - moved / b["size"])
        gives, takes = acc["gives"] - b_down, acc["takes"] - b_up
        paired = state(
            ~(a_done & b_done),
            F.when(a_done, rest_b).otherwise(rest_a),
            F.when(a_done, 0).otherwise(way),
            gives,
            takes,
            done,
        )
        return F.when(acc["open"], paired).otherwise(
            state(F.lit(True), unit(b, b["p"]), F.lit(0), gives, takes, acc["done"])
        )

    def total(x, of):
        return F.aggregate(x, F.lit(0.0), lambda n, m: n + of(m))

    first, others = F.element_at(members, 1), F.slice(members, F.lit(2), F.size(members))
    none = F.slice(F.array(decided(first, F.lit(True))), 1, 0)
    gives = total(others, lambda m: m["p"] * m["size"])
    takes = total(others, lambda m: (1 - m["p"]) * m["size"])
    start = state(F.lit(True), unit(first, first["p"]), F.lit(0), gives, takes, none)
    return F.aggregate(others, start, step)


def fold_blocks(u: DataFrame, level: int, seed: int) -> DataFrame:
    """One row per (source, block) of units: residuals, and ``r`` with the open unit and the decided ones."""
    draw = uniform(F.lit(seed), F.lit(level), "id", "nth").alias("u")
    member = F.struct((-F.col("size")).alias("falling"), draw, "id", "nth", "size", "p")
    blocks = u.groupBy("source", "block").agg(
        F.array_sort(F.collect_list(member)).alias("m"), F.first("residuals").alias("residuals")
    )
    return blocks.select("source", "residuals", fold(F.col("m")).alias("r"))


def copies(u: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(id, nth, source, size, source_size, target, copies) of every unit of ``u`` (id, source, size)."""
    u = materialize(numbered(u), "mix-units")
    per_source = u.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    # one row per source: a dimension table, joined with a null-safe key
    goal = materialize(
        targets(per_source, weights, most).withColumn("residuals", F.ceil(F.col("n") / FANOUT)), "mix-targets"
    )
    left = goal.agg(F.max("residuals")).first()[0] or 0
    dims = goal.withColumnRenamed("source", "s").drop("n")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = u.join(dims, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("p", rate - F.floor(rate))
    paired = (F.col("size") > 0) & (F.col("p") > 0)
    block = F.pmod(F.xxhash64(F.lit(seed), "id", "nth"), F.col("residuals")).alias("block")
    level0 = u.where(paired).select("id", "nth", "source", "size", "p", "residuals", block)
    done, folded = [], fold_blocks(level0, 0, seed)
    level = 0
    while True:
        folded = materialize(folded, f"mix-level{level}")
        done.append(folded.select("source", F.explode("r.done").alias("d")).select("source", "d.*"))
        rest = folded.where("r.open").select("source", "residuals", "r.unit.*")
        if left <= 1:
            break
        level, left = level + 1, -(-left // FANOUT)
        rest = rest.withColumn("residuals", F.ceil(F.col("residuals") / FANOUT))
        block = F.pmod(F.xxhash64(F.lit(seed + level), "id", "nth"), F.col("residuals"))
        folded = fold_blocks(rest.withColumn("block", block), level, seed)
    nearest = F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("extra")
    done.append(rest.select("source", "id", "nth", nearest))
    # sizes and fractions are recomputed from the unit table; only decisions are united
    extra = done[0]
    for d in done[1:]:
        extra = extra.unionByName(d)
    extra = extra.groupBy("id", "nth").agg(F.sum("extra").alias("extra"))
    out = u.select("id", "nth", "source", "size", "source_size", "target", F.floor(rate).alias("whole"))
    return out.join(extra, ["id", "nth"], "left").select(
        "id",
        "nth",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("bigint").alias("copies"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: one row per copy, with the copy's number in ``copy`` (a column of that name is replaced)."""
    plan = copies(units(docs), weights, most, seed)
    # rows that are equal share their copies evenly, so a hot repeated row is a count, not a list
    by_row = plan.groupBy("id").agg(F.sum("copies").alias("__all"), F.count("*").alias("__m"))
    by_row = materialize(by_row.select(F.col("id.doc_id").alias("__d"), F.col("id.row").alias("__r"), "__all", "__m"), "mix-rows")
    names = [c for c in docs.columns if c != "copy"]
    d = docs.select(*names).withColumns({"__doc": F.col("doc_id"), "__row": F.xxhash64("text")})
    hot = by_row.where(F.col("__m") > HOT).select("__d", "__r")
    mine = F.col("__doc").eqNullSafe(F.col("__d")) & (F.col("__row") == F.col("__r"))
    if hot.isEmpty():
        d = numbered_rows(d, [])
    else:
        d = numbered_rows(d.join(hot, mine, "left_anti"), []).unionByName(numbered_hot_rows(d.join(hot, mine, "left_semi")))
    d = d.join(by_row, mine)
    one_more = F.when(F.col("__nth") <= F.col("__all") % F.col("__m"), 1).otherwise(0)
    n = F.floor(F.col("__all") / F.col("__m")) + one_more
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))).alias("copy")
    return d.withColumn("__n", n).where("__n > 0").select(*names, copy)


def numbered_rows(d: DataFrame, salt: list[str]) -> DataFrame:
    """Adds ``__nth`` (1, 2, ...) among the rows of a key (and salt)."""
    return d.withColumn("__nth", F.row_number().over(Window.partitionBy("__doc", "__row", *salt).orderBy("__doc")))


def numbered_hot_rows(d: DataFrame) -> DataFrame:
    """The same for keys of many rows, in no one task: numbered by the partition they were written from, then moved on by the counts before."""
    d = materialize(d.withColumn("__salt", F.spark_partition_id()), "mix-hot")
    key = ["__doc", "__row", "__salt"]
    before = Window.partitionBy("__doc", "__row").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    # one row per key and partition
    offset = d.groupBy(*key).agg(F.count("*").alias("n")).withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offset = offset.select(F.col("__doc").alias("__d0"), F.col("__row").alias("__r0"), F.col("__salt").alias("__s0"), "__before")
    same = F.col("__doc").eqNullSafe(F.col("__d0")) & (F.col("__row") == F.col("__r0")) & (F.col("__salt") == F.col("__s0"))
    out = numbered_rows(d, ["__salt"]).join(offset, same)
    return out.withColumn("__nth", F.col("__nth") + F.col("__before")).drop("__salt", "__d0", "__r0", "__s0", "__before")
