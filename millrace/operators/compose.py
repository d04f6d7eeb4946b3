"""Composition of the final dataset: buckets, the cap, sources, domains and rendered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lexicon import EMOTIONAL, FITNESS_TAGS
from .order import hash_key, threshold
from .score import s as scoring

# Share of emotional-only records, and the template's marks.
EMOTIONAL_SHARE = 0.35
START, STOP = "<|im_start|>", "<|im_end|>"
DEFAULT_SYSTEM = "You are a helpful assistant."


def _fitness(tags: Column) -> Column:
    return F.arrays_overlap(tags, F.array(*map(F.lit, FITNESS_TAGS)))


def bucket(tags: Column, dataset: Column, fitness_sources: list[str]) -> Column:
    return (
        F.when(_fitness(tags) | F.coalesce(dataset.isin(fitness_sources), F.lit(False)), "fitness")
        .when(F.array_contains(tags, EMOTIONAL), "emotional")
        .otherwise("general")
    )


def cap_emotional(df: DataFrame, seed: int, key: str, share: float = EMOTIONAL_SHARE) -> DataFrame:
    """Drop emotional-only rows over their share, the largest hashes first; other buckets stay.

    The allowance comes from one small aggregate, the cut from counts of hash
    prefixes: no window and no top-k gathers the bucket in one task.
    """
    n = {r["bucket"]: r["n"] for r in df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    fitness, emotional = n.get("fitness", 0), n.get("emotional", 0)
    allowed = min(emotional, int(fitness * (share / max(1e-9, 1.0 - share))))
    if not fitness or allowed >= emotional:
        return df
    if not allowed:
        return df.filter("bucket <> 'emotional'")
    h, k = hash_key(seed, F.col(key)), F.col(key)
    cut = threshold(df.filter("bucket = 'emotional'"), allowed, h, k)
    return df.filter((F.col("bucket") != "emotional") | (F.struct(h.alias("h"), k.alias("k")) <= cut))


def source_id(dataset: Column, source: Column, source_type: Column) -> Column:
    blank_null = lambda x: F.when(F.trim(x) != "", x)
    return F.coalesce(blank_null(dataset), blank_null(source), source_type)


def domain(tags: Column, reasons: Column, source: Column, mental_sources: list[str]) -> Column:
    return (
        F.when(scoring.is_off_domain(tags) | F.exists(reasons, lambda r: F.startswith(r, F.lit("off_domain"))), "off-domain")
        .when(source.isin(mental_sources), "mental-health-adjacent")
        .when(F.array_contains(tags, EMOTIONAL) & ~_fitness(tags), "mental-health-adjacent")
        .otherwise("fitness-coaching-adjacent")
    )


def render(m: Column, generation: bool = False) -> Column:
    """Chat template: a default system block unless one leads, then each message between marks."""
    block = lambda role, content: F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(f"{STOP}\n"))
    head = F.when(F.coalesce(F.try_element_at(m, F.lit(1))["role"] == "system", F.lit(False)), "").otherwise(
        block(F.lit("system"), F.lit(DEFAULT_SYSTEM))
    )
    body = F.array_join(F.transform(m, lambda x: block(x["role"], x["content"])), "")
    return F.concat(head, body, F.lit(f"{START}assistant\n" if generation else ""))


def render_plain(m: Column) -> Column:
    """``ROLE: content`` blocks and a last ``ASSISTANT:``."""
    return F.concat(F.array_join(F.transform(m, lambda x: F.concat(F.upper(x["role"]), F.lit(": "), x["content"])), "\n\n"), F.lit("\n\nASSISTANT:"))


def prompt_messages(system: Column, memory: Column, user: Column) -> Column:
    """System and user message, the memory block behind the system text where there is one."""
    content = F.when(memory.isNull(), system).otherwise(F.concat(system, F.lit("\n\n"), memory))
    return F.array(
        F.struct(F.lit("system").alias("role"), content.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content"))
    )


def training_records(scored: DataFrame, source_type: str, mental_sources: list[str] | None = None) -> DataFrame:
    """The 13 columns of the training schema, with fallbacks for those that are missing."""
    have = lambda c, kind="string": F.col(c) if c in scored.columns else F.lit(None).cast(kind)
    tags = F.coalesce(have("topic_tags", "array<string>"), F.array().cast("array<string>"))
    reasons = F.coalesce(have("exclusion_reasons", "array<string>"), F.array().cast("array<string>"))
    source = source_id(have("dataset_id"), have("source_id"), F.lit(source_type))
    return scored.select(
        F.coalesce(have("conversation_id"), have("record_id")).alias("record_id"),
        F.lit(source_type).alias("source_type"),
        source.alias("source_id"),
        have("dataset_id").alias("dataset_id"),
        F.coalesce(have("language"), have("language_hint"), F.lit("unknown")).alias("language"),
        domain(tags, reasons, source, mental_sources or []).alias("domain"),
        tags.alias("topic_tags"),
        have("overall_quality_score", "double").alias("overall_quality_score"),
        have("normalized_sha256").alias("normalized_sha256"),
        F.coalesce(have("quality_flags", "array<string>"), F.array().cast("array<string>")).alias("quality_flags"),
        have("source_license").alias("source_license"),
        F.col("messages").alias("conversations"),
        render(F.col("messages")).alias("text"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Real, synthetic and augmented rows; columns one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
