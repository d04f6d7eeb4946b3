"""Sharding by a hierarchical weighted hash tree, on built-in functions only.

A row descends region, rack and shard. On each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the key and the child's path, and the
smallest draw wins, so a child is chosen with a probability in proportion to
its weight. A draw depends on nothing but the key, the path and that weight:
when a weight changes, rows move only into or out of the subtree that changed.
A new shard comes as a region of its own, so that it only takes rows, and takes
them only into itself; raising a shard's weight moves rows into its region.

Slots number a shard's rows without gaps, in the order of a hash of identifier,
checksum and size. They need no single task per shard: the hash cuts each shard
into cells, as many as the rows need, the table of cell sizes gives every cell
its first slot, and rows are numbered inside their cell. Rows equal in all three
are one row with a count until then, so no cell is larger than others for them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize

#: Rows that a cell should have at most, and copies of one row that are written at a time.
CELL_ROWS, BLOCK = 100_000, 65_536


@dataclass(frozen=True)
class ShardTree:
    """Weights by region, rack and shard; shards are numbered in that order."""

    weights: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def balanced(regions: int, racks: int, shards: int) -> "ShardTree":
        return ShardTree((((1.0,) * shards,) * racks,) * regions)

    def with_new_shard(self, weight: float = 1.0) -> "ShardTree":
        """One more shard, in a region of its own."""
        return ShardTree((*self.weights, ((weight,),)))

    def with_weight(self, region: int, rack: int, shard: int, weight: float) -> "ShardTree":
        w = [[list(r) for r in reg] for reg in self.weights]
        w[region][rack][shard] = weight
        return ShardTree(tuple(tuple(tuple(r) for r in reg) for reg in w))

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.weights for rack in region)


def _doubles(values):
    return F.array(*[F.lit(float(v)) for v in values])


def _bits(text):
    """The first 52 bits of an MD5, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def _uniform(key, path):
    """In (0, 1)."""
    return (_bits(F.concat(key, F.lit("|"), path)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _draws(key, path, weights):
    """A draw for each child; children of weight 0 never win."""
    return F.transform(
        weights,
        lambda w, i: F.struct(
            F.when(w > 0, -F.ln(_uniform(key, F.concat(path, i.cast("string")))) / w)
            .otherwise(F.lit(float("inf")))
            .alias("d"),
            i.alias("i"),
        ),
    )


def _draw(key, path, weights):
    """Index of the child with the smallest draw; ties go to the first."""
    return F.array_min(_draws(key, path, weights))["i"]


def with_shard(df: DataFrame, key, tree: ShardTree, out: str, grown: str | None = None, weight: float = 1.0) -> DataFrame:
    """Add column ``out``: the shard of each row. A null key is a key like any other.

    ``grown``: also a column with the shard under ``tree.with_new_shard(weight)``.
    The new region is one more draw, all below the first level stays as it is.
    """
    k = F.coalesce(key.cast("string"), F.lit("null"))
    racks = F.array(*[_doubles([sum(rack) for rack in region]) for region in tree.weights])
    leaves = F.array(*[F.array(*[_doubles(rack) for rack in region]) for region in tree.weights])
    firsts, n = [], 0
    for region in tree.weights:
        firsts.append([])
        for rack in region:
            firsts[-1].append(n)
            n += len(rack)
    first = F.array(*[F.array(*[F.lit(x) for x in region]) for region in firsts])
    g, r, d = f"{out}__region", f"{out}__rack", f"{out}__draws"
    regions = [sum(map(sum, region)) for region in tree.weights]
    df = df.withColumn(d, _draws(k, F.lit("g"), _doubles([*regions, weight] if grown else regions)))
    df = df.withColumn(g, F.array_min(F.slice(d, 1, len(regions)))["i"])
    df = df.withColumn(
        r, _draw(k, F.concat(F.lit("r"), F.col(g).cast("string"), F.lit(".")), F.get(racks, F.col(g)))
    )
    path = F.concat(F.lit("s"), F.col(g).cast("string"), F.lit("."), F.col(r).cast("string"), F.lit("."))
    leaf = _draw(k, path, F.get(F.get(leaves, F.col(g)), F.col(r)))
    df = df.withColumn(out, (F.get(F.get(first, F.col(g)), F.col(r)) + leaf).cast("int"))
    if grown:
        to_new = F.array_min(d)["i"] == len(regions)
        df = df.withColumn(grown, F.when(to_new, F.lit(tree.n_shards)).otherwise(F.col(out)).cast("int"))
    return df.drop(g, r, d)


def assign_shards(
    docs: DataFrame,
    tree: ShardTree,
    new_weight: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 16 (a null text has none, its CRC is
    that of no bytes); ``grown_shard`` is the shard if one more of ``new_weight``
    comes. Repeated rows share a shard and get slots of their own; a null
    identifier is a key like any other; an empty table gives an empty result;
    other columns are not looked at. A very long text is encoded by its task.
    """
    octets = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    same = ["doc_id", "text_crc32", "size"]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.length(octets).cast("bigint") + 16).alias("size"),
        F.crc32(octets).alias("text_crc32"),
    )
    rows = with_shard(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), F.col("doc_id"), tree, "shard", "grown_shard", new_weight)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in same]
    rows = materialize(rows.withColumn("h", _bits(F.concat_ws("|", *parts))), "shards")  # rows of numbers, no texts
    k = max(0, math.ceil(math.log2(max(1, rows.count() / (tree.n_shards * cell_rows)))))
    rows = rows.withColumn("cell", F.shiftright("h", 52 - k))
    counts = rows.groupBy("shard", "cell").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "cell").orderBy("h", *same).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, ["shard", "cell"])
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(BLOCK).cast("bigint")))
    placed = placed.withColumn("block", block)
    placed = placed.withColumn("one", F.explode(F.sequence("block", F.least(F.col("block") + BLOCK, F.col("n")) - 1)))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("at") + F.col("one")).cast("bigint").alias("slot"),
        "grown_shard",
    )
