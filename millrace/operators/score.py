"""Scores of cleaned conversations and the filter that decides on training use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scoring as s, text as t
from ..functions.plan import once
from ..functions.lexicon import STOCK, Lexicon

# Floors of the eligibility filter.
MIN_DOMAIN, MIN_QUALITY = 0.50, 0.55


def final_exchange(m: Column) -> tuple[Column, Column]:
    """The last user message before the last assistant message, and that message; empty where missing."""
    at = F.transform(m, lambda x, i: F.struct(i.alias("i"), x["role"].alias("role"), x["content"].alias("content")))
    last = F.try_element_at(F.filter(at, lambda x: x["role"] == "assistant"), F.lit(-1))
    user = F.try_element_at(F.filter(at, lambda x: (x["role"] == "user") & (x["i"] < last["i"])), F.lit(-1))
    return F.coalesce(user["content"], F.lit("")), F.coalesce(last["content"], F.lit(""))


def score(cleaned: DataFrame, lex: Lexicon = STOCK, messages: str = "messages", hint: str = "language_hint") -> DataFrame:
    """Add eleven score columns to cleaned conversations; one projection, no shuffle."""
    user, assistant = final_exchange(F.col(messages))
    return score_texts(once(cleaned, final_user=user, final_assistant=assistant), lex, hint)


def score_texts(df: DataFrame, lex: Lexicon, hint: str = "language_hint") -> DataFrame:
    """The same for rows that have ``final_user`` and ``final_assistant``."""
    df = once(
        df,
        __both=t.fold(F.concat(F.col("final_user"), F.lit("\n"), F.col("final_assistant"))),
        __folded=t.fold(F.col("final_assistant")),
        __parts=t.sentences(F.coalesce("final_assistant", F.lit(""))),
    )
    both, folded, answer = F.col("__both"), F.col("__folded"), F.col("final_assistant")
    df = once(df, topic_tags=s.topic_tags(both, lex))
    tags = F.col("topic_tags")
    df = once(
        df,
        __domain=s.domain_relevance(tags, both, lex),
        __weak=s.weak_domain(tags, both, lex),
        __coaching=s.coaching_signal(answer, folded, lex),
        __specific=s.specificity(answer, lex, F.col("__parts")),
        __emotion=s.emotional(F.col("final_user"), answer, F.col(hint), lex, folded),
        __cliche=s.cliche_penalty(folded, lex),
        __safety=s.safety_penalty(folded, lex),
        __repeat=s.repetition_penalty(answer, F.col("__parts")),
    )
    parts = [F.col(f"__{c}") for c in ("domain", "coaching", "specific", "emotion", "cliche", "safety", "repeat")]
    df = df.withColumn("__overall", s.aggregate(*parts))
    off = s.is_off_domain(tags)
    reasons = F.array_compact(
        F.array(
            F.when(off, "off_domain_programming"),
            F.when(F.col("__weak"), "weak_domain_signal"),
            F.when((F.col("__domain") < MIN_DOMAIN) & ~off, "low_domain_relevance"),
            F.when(F.col("__overall") < MIN_QUALITY, "low_quality_score"),
        )
    )
    df = df.withColumns(
        {
            "domain_relevance_score": F.bround("__domain", 4),
            "coaching_signal_score": F.bround("__coaching", 4),
            "specificity_score": F.bround("__specific", 4),
            "emotional_acknowledgment_score": F.bround("__emotion", 4),
            "cliche_penalty": F.bround("__cliche", 4),
            "safety_penalty": F.bround("__safety", 4),
            "repetition_penalty": F.bround("__repeat", 4),
            "overall_quality_score": F.bround("__overall", 4),
            "exclusion_reasons": reasons,
        }
    )
    df = df.withColumn("passes_training_filter", F.size("exclusion_reasons") == 0)
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def report(scored: DataFrame) -> DataFrame:
    """One row: counts, means of the rounded scores, and the emotional mean over those that have one."""
    return scored.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if("passes_training_filter").alias("passing"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("domain_relevance_score", "coaching_signal_score", "specificity_score", "overall_quality_score")],
        F.avg("emotional_acknowledgment_score").alias("avg_emotional"),
        F.count("emotional_acknowledgment_score").alias("emotional_records"),
    )


def label_counts(df: DataFrame, labels: str) -> DataFrame:
    """Label and count of an array column."""
    return df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
