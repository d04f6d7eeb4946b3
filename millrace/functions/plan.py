"""Shaping of plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once, whatever uses them later.

    The optimizer writes a column's expression into every place that names it,
    filters included. It does not do so through a generator, so the values go
    through one that gives a single row; no row is added, moved or lost.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[x.alias(c) for c, x in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.array(row)).alias("__once")).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col("__once")[c].alias(c) for c in columns]
    )


def let(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once for a row, however often ``use`` names it."""
    return F.transform(F.array(x), use)[0]
