"""Scores of model responses against prompts, and rankings of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scoring as s, text as t
from ..functions.lexicon import RAW_FIELDS

# Categories, their weights and how many prompts each must have.
WEIGHTS = {"emotional_acknowledgment": 0.30, "memory_usage": 0.30, "personalization_quality": 0.25, "scientific_accuracy": 0.15}
SUITE = {"emotional_acknowledgment": 8, "memory_usage": 6, "personalization_quality": 5, "scientific_accuracy": 6}


def score_responses(responses: DataFrame) -> DataFrame:
    """Add ``score``; needs category, response, groups, accepted and rejected."""
    raw = F.col("response")
    df = responses.withColumn("__f", t.fold(raw))
    x, c = F.col("__f"), F.col("category")
    score = (
        F.when(c == "emotional_acknowledgment", s.acknowledgement(raw))
        .when(c == "memory_usage", s.memory_usage(x, raw, F.col("groups"), RAW_FIELDS))
        .when(c == "personalization_quality", s.personalization(x, F.col("groups")))
        .when(c == "scientific_accuracy", s.scientific_accuracy(x, F.col("accepted"), F.col("rejected")))
        .otherwise(F.lit(0.0))
    )
    return df.withColumn("score", score).drop("__f")


def category_scores(scored: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Mean by category (absent: 0) and the weighted sum, a row per model."""
    means = [F.coalesce(F.avg(F.when(F.col("category") == c, F.col("score"))), F.lit(0.0)).alias(c) for c in weights]
    out = scored.groupBy("model").agg(*means)
    total = F.lit(0.0)
    for c, w in weights.items():
        total = total + F.col(c) * w
    return out.withColumn("weighted_score", total)


def ranking(models: DataFrame, ordinal: str) -> DataFrame:
    """Best first, equals in the order given."""
    return models.orderBy(F.desc("weighted_score"), ordinal)


def run(models: list[str], prompts: DataFrame, respond, weights: dict[str, float] = WEIGHTS) -> tuple[DataFrame, dict[str, str]]:
    """Category scores of all models that answered, best first, and why the others did not.

    ``respond(model, prompts)`` gives the prompts with a column ``response``; a
    model whose answers fail is skipped, and none left is an error. The first
    row is the winner.
    """
    scored, failed = None, {}
    for i, model in enumerate(models):
        try:
            one = score_responses(respond(model, prompts).withColumn("model", F.lit(model)))
            one = category_scores(one, weights).withColumn("ordinal", F.lit(i))
            one = one.sparkSession.createDataFrame(one.collect(), one.schema)  # a row a model, here so that it fails here
        except Exception as e:  # noqa: BLE001 - whatever a model's answers end in
            failed[model] = str(e).splitlines()[0]
            continue
        scored = one if scored is None else scored.unionByName(one)
    if scored is None:
        raise RuntimeError(f"no model could be evaluated: {failed}")
    return ranking(scored, "ordinal"), failed


def suite_errors(prompts: DataFrame, expected: dict[str, int] = SUITE) -> DataFrame:
    """Categories whose number of prompts is not the expected one."""
    spark = prompts.sparkSession
    want = spark.createDataFrame(list(expected.items()), "category string, expected bigint")
    got = prompts.groupBy("category").agg(F.count(F.lit(1)).alias("found"))
    both = want.join(got, "category", "full").na.fill(0, ["expected", "found"])
    return both.filter("expected <> found")
