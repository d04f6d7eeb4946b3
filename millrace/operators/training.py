"""Validation, holdout and truncation of training records."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as t
from ..sources.sinks import write_jsonl
from ..sources.store import shared_dir
from .compose import render

REQUIRED = ["record_id", "source_id", "language", "domain", "conversations", "text"]


def record_error(df: DataFrame) -> Column:
    """First broken rule of a training record, or null."""
    m = F.col("conversations")
    error = None
    for c in REQUIRED:
        missing = F.col(c).isNull() if c in df.columns else F.lit(True)
        error = F.when(missing, f"missing_{c}") if error is None else error.when(missing, f"missing_{c}")
    return (
        error.when(t.strip(F.col("record_id")) == "", "blank_record_id")
        .when(F.size(m) == 0, "no_messages")
        .when(F.exists(m, lambda x: ~F.coalesce(x["role"].isin("system", "user", "assistant"), F.lit(False))), "unknown_role")
        .when(F.element_at(m, -1)["role"] != "assistant", "last_is_not_assistant")
        .when(t.strip(F.col("text")) == "", "blank_text")
        .when(F.col("text") != render(m), "text_differs_from_template")
    )


class DatasetError(ValueError):
    """Malformed training records."""


def malformed(df: DataFrame, place: Column | None = None) -> DataFrame:
    """Every malformed record: its place and the first rule it breaks."""
    at = place if place is not None else F.col("record_id")
    return df.select(at.cast("string").alias("at"), record_error(df).alias("error")).filter("error IS NOT NULL")


def validated(df: DataFrame, place: Column | None = None, report: str | None = None) -> DataFrame:
    """``df`` when all records are sound, else an error.

    Every place is written as JSON lines to ``report`` (a folder of the shared
    one where none is given), which the error names; a thousand of them stand in
    the error itself.
    """
    bad = malformed(df, place)
    some = bad.orderBy("at").limit(1000).collect()
    if some:
        report = report or f"{shared_dir(df.sparkSession)}/malformed-{uuid.uuid4().hex}"
        write_jsonl(bad, report)
        n = len(some) if len(some) < 1000 else bad.count()
        raise DatasetError(f"{n} malformed records, all of them in {report}: " + ", ".join(f"{r['at']} ({r['error']})" for r in some))
    return df


def failing_fast(df: DataFrame) -> DataFrame:
    """The same check inside the plan: the first malformed record that is read raises."""
    error = record_error(df)
    return df.withColumn("record_id", F.when(error.isNull(), F.col("record_id")).otherwise(F.raise_error(error).cast("string")))


def tokenize(df: DataFrame, ids: Column, max_length: int = 2048, mask: bool = True) -> DataFrame:
    """Truncated ids, labels as their copy and an attention mask; no ids at all are an error."""
    cut = F.slice(ids, 1, max_length)
    checked = F.when(F.size(ids) > 0, cut).otherwise(F.raise_error(F.lit("a record has no tokens")).cast(df.select(ids).schema[0].dataType))
    df = df.withColumn("input_ids", checked).withColumn("labels", F.col("input_ids"))
    return df.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))) if mask else df


def tokenizer_ids(path: str):
    """A pandas UDF that encodes texts with a tokenizer file."""

    @F.pandas_udf("array<int>")
    def ids(x):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        return x.map(lambda v: tok.encode(v or "", add_special_tokens=False).ids)

    return ids


def load(train: DataFrame, validation: DataFrame | None, ratio: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows: the file given for it, else a holdout."""
    from .order import holdout

    if validation is not None:
        return validated(train), validated(validation)
    split = holdout(validated(train), ratio, seed, "record_id")
    return split.filter("NOT is_validation").drop("is_validation"), split.filter("is_validation").drop("is_validation")
