"""Exact deduplication by a content sort.

Sampled splitters range-partition the rows by their normalised bytes, an
external sort inside each partition places equals next to each other, and a
stream over the sorted rows compares every text with its neighbour in full.

Spark's range partitioner takes the sample and its sorter spills, so neither
holds a partition in memory. Splitters are short, as samples come to the driver:
a text's first characters, its SHA-256 where those are equal, and the identifier
at last, so that a group of copies of any size may be cut over several
partitions. Inside a partition rows are sorted by their bytes and the identifier,
the one that stays first; so a row is known to stay or go as it passes, and only
a run's size has to wait for its end. Sizes are written apart, a row for each run
of several, and joined back.

A group that was cut goes on in the next partition. It can only be the one with
the last splitter of a partition or the first; these, two at most of each
partition, are written with their texts and put together by comparing them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import few, lower_ascii, materialize, partitions

P = "__xd_"
RESULT = [P + c for c in ("keep_id", "group_size", "kept", "text_sha256")]
ROW, SEVERAL, EDGE = 0, 1, 2
EXTRA = [
    (P + "kind", T.IntegerType(), pa.int32()),
    (P + "part", T.LongType(), pa.int64()),
    (P + "run", T.LongType(), pa.int64()),
    (P + "first", T.BooleanType(), pa.bool_()),
    (P + "n", T.LongType(), pa.int64()),
    (P + "keep", T.LongType(), pa.int64()),
    (P + "norm", T.StringType(), pa.string()),
]


@dataclass
class _Run:
    run: int
    n: int
    keep: int | None
    head: str
    sha: str
    text: pa.Scalar


def _runs(fields: list[str]):
    """Rows of one sorted partition with the number of their run, and rows about runs. Holds three texts at most."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now = before = first = last = None
        number, kinds = -1, {}

        def about(kind: int, runs: list[_Run]):
            k = len(runs)
            cols = [pa.nulls(k, kinds[c]) for c in fields]
            own = [[kind] * k, [part] * k, [r.run for r in runs], [None] * k, [r.n for r in runs], [r.keep for r in runs]]
            own.append([r.text.as_py() if kind == EDGE else None for r in runs])
            cols += [pa.array(c, t) for c, (_, _, t) in zip(own, EXTRA, strict=True)]
            return pa.RecordBatch.from_arrays(cols, names=[*fields, *(c for c, *_ in EXTRA)])

        def close():
            nonlocal first, last
            if first is None or (now.head == first.head and now.sha < first.sha):
                first = now
            if last is None or now.head != last.head or now.sha > last.sha:
                last = now

        for batch in batches:
            n = batch.num_rows
            kinds = {c: batch.schema.field(c).type for c in fields}
            if not n:
                continue
            norm = batch.column(P + "norm")
            new = np.ones(n, bool)
            new[0] = norm[0].as_py() != before
            if n > 1:
                new[1:] = ~pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            runs = number + np.cumsum(new)
            number = int(runs[-1])
            at = pa.array(starts)
            heads, shas, ids = (batch.column(P + c).take(at).to_pylist() for c in ("head", "sha", "id"))
            several = []
            if now is not None:
                now.n += int(starts[0]) if len(starts) else n
            for k, (s, stop) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True)):
                if now is not None:
                    close()
                    if now.n > 1:
                        several.append(now)
                now = _Run(int(runs[s]), stop - s, ids[k], heads[k], shas[k], norm[s])
            if len(starts):
                before = now.text.as_py()
            own = [[ROW] * n, [part] * n, runs, new, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
            cols = [batch.column(c) for c in fields] + [pa.array(c, t) for c, (_, _, t) in zip(own, EXTRA, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=[*fields, *(c for c, *_ in EXTRA)])
            if several:
                yield about(SEVERAL, several)
        if now is not None:
            close()
            if now.n > 1:
                yield about(SEVERAL, [now])
            yield about(EDGE, [first] if first is last else [first, last])

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    carry: list[str] | None = None,
    sizes: bool = True,
    prefix: int = 24,
) -> DataFrame:
    """One row per input row: the carried columns, then __xd_keep_id, __xd_group_size, __xd_kept, __xd_text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. ``keep`` says whether the smallest or the largest identifier stays;
    of rows that repeat an identifier and a text exactly one stays. A null
    identifier stays only where its group has no other. Without ``sizes`` only
    __xd_kept and __xd_text_sha256 are given, and no table of runs is joined.
    Carried columns keep their names, but those that have a name of the result
    are left out. An empty table gives no rows. A text of any length is held
    three times at most by one task.
    """
    spark = docs.sparkSession
    carry = [c for c in ([id_col] if carry is None else carry) if c not in RESULT]
    inner = {c: f"{P}c{i}" for i, c in enumerate(carry)}
    n = partitions(spark)
    rows = docs.select(
        *[F.col(f"`{c}`").alias(name) for c, name in inner.items()],
        F.col(id_col).cast("bigint").alias(P + "id"),
        lower_ascii(F.col(text_col)).alias(P + "norm"),
    )
    rows = rows.withColumn(P + "head", F.substring(P + "norm", 1, prefix))
    rows = rows.withColumn(P + "sha", F.sha2(F.encode(P + "norm", "UTF-8"), 256))
    order = F.desc_nulls_last(P + "id") if keep == "largest" else F.asc_nulls_last(P + "id")
    rows = rows.repartitionByRange(n, P + "head", P + "sha", order).sortWithinPartitions(P + "norm", order)
    fields = [*inner.values(), P + "id", P + "sha"]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in fields] + [T.StructField(a, b) for a, b, _ in EXTRA])
    all_rows = materialize(rows.mapInArrow(_runs(fields), schema), "exact-dedup")
    place = [P + "part", P + "run"]
    edges = all_rows.filter(F.col(P + "kind") == EDGE).select(*place, P + "n", P + "keep", P + "norm")
    whole = edges.groupBy(P + "norm").agg(F.sum(P + "n").alias(P + "all"), F.min(F.struct(P + "part", P + "keep")).alias(P + "lead"))
    edges = edges.join(whole, P + "norm").select(*place, P + "all", P + "lead")
    # Two rows a partition at most.
    found = all_rows.filter(F.col(P + "kind") == ROW).drop(P + "n", P + "keep").join(F.broadcast(edges), place, "left")
    stays = F.col(P + "first") & (F.coalesce(F.col(P + "lead")[P + "part"], F.col(P + "part")) == F.col(P + "part"))
    out = [F.col(name).alias(c) for c, name in inner.items()]
    if sizes:
        several = all_rows.filter(F.col(P + "kind") == SEVERAL).select(*place, P + "n", P + "keep")
        found = found.join(few(several), place, "left")
        lead = F.when(F.col(P + "lead").isNotNull(), F.col(P + "lead")[P + "keep"])
        alone = F.when(F.col(P + "n").isNotNull(), F.col(P + "keep")).otherwise(F.col(P + "id"))
        out.append(F.when(F.col(P + "lead").isNotNull(), lead).otherwise(alone).alias(RESULT[0]))
        out.append(F.coalesce(P + "all", P + "n", F.lit(1)).alias(RESULT[1]))
    return found.select(*out, stays.alias(RESULT[2]), F.col(P + "sha").alias(RESULT[3]))
