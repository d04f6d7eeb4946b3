"""Stratified splits by largest remainders, and the spot check of what was split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as t
from .compose import render
from .order import ranked, sample


@dataclass(frozen=True)
class Targets:
    train: int
    validation: int
    test: int


def targets(n: int, validation: float = 0.05, test: float = 0.05, least: tuple[int, int, int] = (10_000, 500, 500)) -> Targets:
    """Split sizes; halves round to even, and too few training rows are an error."""
    v, e = max(least[1], round(n * validation)), max(least[2], round(n * test))
    if n - v - e < least[0]:
        raise RuntimeError(f"too few records: train={n - v - e}, validation={v}, test={e}")
    return Targets(n - v - e, v, e)


def allocate(groups: DataFrame, target: int, ratio: float, group: str = "source_id", size: str = "n", reserved: str | None = None) -> DataFrame:
    """Add ``allocated`` to a table of group sizes.

    First the whole part of size times ratio, as far as rows are available; then
    one each by the largest remainder; what is still left goes to the largest
    groups as far as they have rows. A target out of reach is an error. The
    table has a row per source, so its windows order few rows.
    """
    res = F.coalesce(F.col(reserved), F.lit(0)) if reserved else F.lit(0)
    g = groups.withColumn("__avail", F.greatest(F.col(size) - res, F.lit(0)))
    raw = F.col(size) * F.lit(float(ratio))
    g = g.withColumn("__base", F.least(F.floor(raw), F.col("__avail")))
    g = g.withColumn("__rem", F.when(F.col("__avail") > 0, raw - F.col("__base")).otherwise(F.lit(0.0)))
    g = g.withColumn("__room", F.col("__avail") - F.col("__base"))
    before = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    g = g.withColumn("__need", F.greatest(F.lit(target) - F.sum("__base").over(whole), F.lit(0)))
    open_ = (F.col("__room") > 0).cast("int")
    taken = F.coalesce(F.sum(open_).over(before(F.desc("__rem"), group)), F.lit(0))
    g = g.withColumn("__one", F.when((F.col("__room") > 0) & (taken < F.col("__need")), 1).otherwise(0))
    g = g.withColumn("__left", F.col("__need") - F.sum("__one").over(whole)).withColumn("__room", F.col("__room") - F.col("__one"))
    poured = F.coalesce(F.sum("__room").over(before(F.desc(size), group)), F.lit(0))
    more = F.least(F.col("__room"), F.greatest(F.col("__left") - poured, F.lit(0)))
    g = g.withColumn("allocated", (F.col("__base") + F.col("__one") + more).cast("bigint"))
    total = F.sum("allocated").over(whole)
    wrong = F.raise_error(F.concat(F.lit(f"target {target} cannot be allocated: "), total.cast("string"))).cast("bigint")
    g = g.withColumn("allocated", F.when(total == target, F.col("allocated")).otherwise(wrong))
    return g.drop(*[c for c in g.columns if c.startswith("__")])


def stratified(df: DataFrame, to: Targets, ratios: tuple[float, float], seed: int, key: str, group: str = "source_id") -> DataFrame:
    """Add ``split``: within each source, by hash order, validation first, then test, then training."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    val = allocate(sizes, to.validation, ratios[0], group).withColumnRenamed("allocated", "validation")
    both = allocate(val, to.test, ratios[1], group, reserved="validation").withColumnRenamed("allocated", "test")
    rows = ranked(df, seed, key, [group]).join(both.select(group, "validation", "test"), group)
    split = (
        F.when(F.col("rank") <= F.col("validation"), "validation")
        .when(F.col("rank") <= F.col("validation") + F.col("test"), "test")
        .otherwise("train")
    )
    return rows.withColumn("split", split).select(*df.columns, "split")


def blank_tokens(x: Column) -> Column:
    """Words between white space: the default token count."""
    return F.size(F.filter(F.split(x, f"{t.SPACE}+"), lambda w: w != ""))


def spot_check(
    df: DataFrame, k: int = 50, max_tokens: int = 2048, seed: int = 42, key: str = "record_id", count=blank_tokens, messages: str = "conversations"
) -> DataFrame:
    """One row on a sample: malformed and over-length rows, mean and largest token count, truncation rate."""
    rows = sample(df, k, seed + 101, key)
    text = F.col("text")
    bad = (
        F.coalesce(t.strip(text) == "", F.lit(True))
        | F.coalesce(F.size(messages) == 0, F.lit(True))
        | F.coalesce(text != render(F.col(messages)), F.lit(True))
    )
    rows = rows.select(bad.alias("bad"), count(F.coalesce(text, F.lit(""))).alias("tokens"))
    over = F.col("tokens") > max_tokens
    out = rows.agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count_if("bad").alias("malformed"),
        F.count_if(over).alias("over_length"),
        F.bround(F.avg("tokens"), 2).alias("avg_tokens"),
        F.max("tokens").cast("bigint").alias("max_tokens"),
    )
    rate = F.coalesce(F.col("over_length") / F.nullif(F.col("sampled"), F.lit(0)), F.lit(0.0))
    status = F.when((F.col("malformed") > 0) | (F.col("over_length") > 0), "FAIL").otherwise("PASS")
    return out.withColumns({"truncation_rate": rate, "status": status})
