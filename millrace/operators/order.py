"""Deterministic order, samples and quotas by hash.

A shuffle that follows the order of its input cannot be had in a distributed
plan. Rows are ordered by SHA-256 of seed, group and identifier instead: as
deterministic, sensitive to the seed, and the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def hash_key(seed: int, *parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)


def sample(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``k`` rows without replacement: the smallest hashes (a top-k, no full sort)."""
    return df.orderBy(hash_key(seed, F.col(key)), key).limit(k)


#: Leading hex digits of a hash that cut a group into cells, and that cut a table to find a threshold.
CELL_DIGITS, CUT_DIGITS = 3, 5


def ranked(df: DataFrame, seed: int, key: str, by: list[str]) -> DataFrame:
    """Add ``rank``, from 1, in hash order within each group.

    A group may hold most of the rows, so its hashes' first digits cut it into
    cells. The sizes of cells, a small table, give each its first rank, and rows
    are ranked inside their cell.
    """
    groups = [f"__g{i}" for i in range(len(by))]
    h = hash_key(seed, *map(F.col, by), F.col(key))
    # A null group is one like any other: it joins by a text.
    rows = df.withColumn("__h", h).withColumns({g: F.coalesce(F.to_json(F.struct(c)), F.lit("")) for g, c in zip(groups, by, strict=True)})
    rows = rows.withColumn("__cell", F.substring("__h", 1, CELL_DIGITS))
    sizes = rows.groupBy(*groups, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*groups, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(*groups, "__cell").orderBy("__h", key)
    rows = rows.withColumn("__at", F.row_number().over(inside)).join(first, [*groups, "__cell"])
    return rows.select(*df.columns, (F.col("__first") + F.col("__at")).alias("rank"))


def threshold(df: DataFrame, k: int, h: Column, key: Column) -> Column | None:
    """The ``k``-th smallest pair of hash and key, as a literal; null for none.

    One aggregate counts rows by the hash's first digits (a million numbers come
    to the driver at most); only the cell that holds the pair is put in order.
    """
    if k < 1:
        return None
    cells = df.groupBy(F.substring(h, 1, CUT_DIGITS).alias("c")).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("c")
    before = 0
    for cell, n in zip(cells["c"].to_pylist(), cells["n"].to_pylist(), strict=True):
        if before + n >= k:
            inside = df.filter(F.substring(h, 1, CUT_DIGITS) == cell).select(F.struct(h.alias("h"), key.alias("k")).alias("o"))
            last = inside.orderBy("o").limit(k - before).agg(F.max("o").alias("o")).first()["o"]
            return F.struct(F.lit(last["h"]).alias("h"), F.lit(last["k"]).cast(df.select(key).schema[0].dataType).alias("k"))
        before += n
    raise ValueError(f"fewer than {k} rows")


def first_k(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """The first ``k`` of the global hash order, from a bounded table by top-k."""
    return sample(df, k, seed, key)


def holdout(df: DataFrame, ratio: float, seed: int, key: str) -> DataFrame:
    """Add ``is_validation``: round(n * ratio) rows, one at least and all but one at most.

    No row leaves its partition. Fewer than two rows are an error.
    """
    n = df.count()
    if n < 2:
        raise ValueError("a holdout needs two records at least")
    h, k = hash_key(seed, F.col(key)), F.col(key)
    cut = threshold(df, max(1, min(n - 1, round(n * ratio))), h, k)
    return df.withColumn("is_validation", F.struct(h.alias("h"), k.alias("k")) <= cut)


def balanced_quota(values: DataFrame, total: int, seed: int, key: str) -> DataFrame:
    """``total`` slots over the values, as even as can be: (slot, value), in hash order.

    The first values in hash order take the remainder. ``values`` is a library,
    so a window without partitions orders a few rows.
    """
    n = values.count()
    per, extra = divmod(total, n)
    w = Window.orderBy(hash_key(seed, F.col(key)), key)
    quota = values.withColumn("pos", F.row_number().over(w)).withColumn("quota", F.lit(per) + (F.col("pos") <= extra).cast("int"))
    slots = quota.filter("quota > 0").select(key, F.explode(F.sequence(F.lit(1), "quota")).alias("k"))
    order = Window.orderBy(hash_key(seed, F.lit("slot"), F.col(key), F.col("k")), key, "k")
    return slots.select((F.row_number().over(order) - 1).alias("slot"), F.col(key).alias("value"))
