"""A cleaning pipeline over the documents table, from the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. Each works on all that its predecessor kept; all but the last
return the columns they were given, whatever their names. Nulls, empty and very
long texts, ties, repeated rows and empty tables are treated as the operator of
the stage says. A stage's intermediate tables are deleted once it is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import common, decontaminate, exact_dedup, jaccard_join, packing, toxicity


def _aside(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` with columns out of the operators' way that are named as theirs are, and how to get them back."""
    names = {c: f"kept_{i}" if c.startswith("__") else c for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(f"`{new}`").alias(c) for c, new in names.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score of 0.5 or more) go.

    It learns from all labelled rows among ``docs`` that are not held out.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    docs, back = _aside(docs)
    return toxicity.score(docs, model, out="__tx_score").filter(F.col("__tx_score") < 0.5).select(back)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text the largest doc_id stays."""
    docs, back = _aside(docs)
    return exact_dedup.exact_dedup(docs, keep="largest", carry=docs.columns, sizes=False).filter("__xd_kept").select(back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies the smallest doc_id stays: five-word shingles, a similarity of 0.8."""
    found = jaccard_join.jaccard_components(docs, k=5, percent=80)
    gone = found.filter("component_id < doc_id").select(F.col("doc_id").alias("__jj_id"))
    docs, back = _aside(docs)
    return docs.join(common.few(gone), F.col("doc_id") == F.col("__jj_id"), "left_anti").select(back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, back = _aside(docs)
    return decontaminate.decontaminate(docs, bench).filter("__dc_n_hit = 0").select(back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, a row for each piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, from the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with common.scratch(spark) as keep:
        for name, stage in STAGES:
            with common.scratch(spark) as stay:
                docs = stay(common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        return keep(docs)


#: Neither the classifier nor the tokenizer can be put in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None
