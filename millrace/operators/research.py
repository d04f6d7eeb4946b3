"""Ranking and filtering of models, datasets and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scoring as s, text as t

# Licences, weights, budget, themes.
MODEL_LICENSES = ["apache-2.0", "mit"]
DATASET_LICENSES = ["apache-2.0", "cc-by-4.0", "cc0-1.0", "mit", "odc-by", "pddl", "bsd-2-clause", "bsd-3-clause"]
REJECTED_TOKENS = ["arr", "nc", "non-commercial", "other", "rail", "unknown"]
MODEL_WEIGHTS = {
    "instruction_following": 0.25,
    "reasoning_quality": 0.15,
    "hallucination_proxy": 0.20,
    "emotional_awareness": 0.15,
    "mobile_deployment": 0.10,
    "fine_tuning_efficiency": 0.10,
}
PARAMETER_BUDGET = 2.2e9
THEMES = [
    (["memory", "personalization", "event sourcing"], ["convers", "dialog", "language model", "llm", "assistant", "agent", "user", "retrieval"]),
    (["health", "fitness", "nutrition", "exercise"], ["health", "fitness", "exercise", "nutrition", "coaching", "medical"]),
    (["hallucination", "retrieval", "generation"], ["language model", "llm", "generation", "retrieval", "question answering", "reasoning"]),
    (["emotion", "coaching", "motivation", "retention"], ["emotion", "empathy", "coaching", "dialog", "conversation", "motivation", "behavior", "counsel"]),
]
BANNED = ["visual tracking", "rgb-event", "video tracking", "object tracking", "sensor fusion", "image generation"]
METRIC_PATHS = {
    "ifeval_strict": ("leaderboard", "inst_level_strict_acc,none"),
    "ifeval_loose": ("leaderboard", "inst_level_loose_acc,none"),
    "bbh": ("leaderboard_bbh", "acc_norm,none"),
    "gpqa": ("leaderboard_gpqa", "acc_norm,none"),
    "math_hard": ("leaderboard_math_hard", "exact_match,none"),
    "musr": ("leaderboard_musr", "acc_norm,none"),
    "mmlu_pro": ("leaderboard_mmlu_pro", "acc,none"),
}


def _any(x: Column, tokens: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, tokens)), lambda p: F.contains(x, p))


def license_decision(license: Column) -> Column:
    x = F.lower(F.trim(license))
    token = F.try_element_at(F.filter(F.array(*map(F.lit, REJECTED_TOKENS)), lambda p: F.contains(x, p)), F.lit(1))
    return (
        F.when(F.coalesce(x, F.lit("")) == "", "missing_license")
        .when(x.isin(DATASET_LICENSES), "approved")
        .when(token.isNotNull(), F.concat(F.lit("rejected:"), x))
        .otherwise(F.concat(F.lit("manual_review_needed:"), x))
    )


def license_of(card: Column, tags: Column) -> Column:
    """The card's licence, else the first tag that names one; lower case."""
    tagged = F.try_element_at(F.filter(tags, lambda x: F.startswith(x, F.lit("license:"))), F.lit(1))
    return F.lower(F.coalesce(card, F.substring(tagged, F.lit(9), F.length(tagged))))


def parameter_count(total: Column, parts: Column) -> Column:
    return F.coalesce(total, F.array_max(F.map_values(parts)))


def filter_reason(found: Column, license: Column, parameters: Column, has_metrics: Column) -> Column:
    return (
        F.when(~found, "not_found")
        .when(~F.coalesce(license.isin(MODEL_LICENSES), F.lit(False)), F.concat(F.lit("license="), F.coalesce(license, F.lit("None"))))
        .when(parameters > PARAMETER_BUDGET, "over_parameter_budget")
        .when(~has_metrics, "missing_leaderboard_metrics")
    )


def min_max(x: Column, inverse: bool = False) -> Column:
    """Over all rows of a table of candidates: 0 to 1, equal values 1 (inverse: 0)."""
    w = Window.partitionBy()
    low, high = F.min(x).over(w), F.max(x).over(w)
    scaled = F.when(high == low, F.lit(1.0)).otherwise((x - low) / F.nullif(high - low, F.lit(0.0)))
    return F.when(x.isNotNull(), 1.0 - scaled if inverse else scaled)


def weighted_score(dimensions: dict[str, Column]) -> Column:
    """Weighted mean in which a null dimension counts 0; null when all are."""
    total, top = sum(MODEL_WEIGHTS.values()), F.lit(0.0)
    for name, weight in MODEL_WEIGHTS.items():
        top = top + F.coalesce(dimensions[name], F.lit(0.0)) * weight
    return F.when(F.coalesce(*dimensions.values()).isNotNull(), top / F.lit(total))


def rank_models(models: DataFrame) -> DataFrame:
    """Scaled dimensions over all found models, weighted score, filter reason and rank.

    Needs model_id, found, license, parameter_count and the metrics of
    ``METRIC_PATHS`` with eq_bench. A score of 0 ranks like -1.
    """
    found = models.filter("found")
    m = {c: min_max(F.col(c)) for c in (*METRIC_PATHS, "eq_bench")}
    small = min_max(F.col("parameter_count").cast("double"), inverse=True)
    found = found.withColumns({f"__{k}": v for k, v in m.items()} | {"__small": small})
    c = lambda k: F.col(f"__{k}")
    dims = {
        "instruction_following": s.mean_of(c("ifeval_strict"), c("ifeval_loose")),
        "reasoning_quality": s.mean_of(c("bbh"), c("gpqa"), c("math_hard"), c("musr")),
        "hallucination_proxy": s.mean_of(c("mmlu_pro"), c("gpqa")),
        "emotional_awareness": c("eq_bench"),
        "mobile_deployment": c("small"),
        "fine_tuning_efficiency": c("small"),
    }
    has = F.coalesce(*[F.col(k) for k in METRIC_PATHS]).isNotNull()
    found = found.withColumn("weighted_score", weighted_score(dims))
    found = found.withColumn("filter_reason", filter_reason(F.col("found"), F.col("license"), F.col("parameter_count"), has))
    missing = models.filter("NOT found").withColumn("weighted_score", F.lit(None).cast("double")).withColumn("filter_reason", F.lit("not_found"))
    out = found.unionByName(missing, allowMissingColumns=True).drop(*[x for x in found.columns if x.startswith("__")])
    key = F.when(F.coalesce(F.col("weighted_score"), F.lit(0.0)) == 0.0, F.lit(-1.0)).otherwise(F.col("weighted_score"))
    w = Window.orderBy(F.col("weighted_score").isNotNull().desc(), key.desc(), "model_id")
    return out.withColumn("rank", F.row_number().over(w))


def resolve(requested: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per requested id with the metadata it stands for, not-found rows kept.

    ``hits`` (requested_id, position, model_id, pipeline_tag and metadata) has the
    direct lookup at position 0 and search results behind it. The direct one
    wins, else the first hit that generates text.
    """
    fits = (F.col("position") == 0) | (F.col("pipeline_tag") == "text-generation")
    rest = [c for c in hits.columns if c not in ("requested_id", "position")]
    first = hits.filter(fits).groupBy("requested_id").agg(F.min_by(F.struct(*rest), "position").alias("m"))
    joined = requested.select("requested_id").join(first, "requested_id", "left")
    cols = [F.col("m")[c].alias("resolved_id" if c == "model_id" else c) for c in rest]
    return joined.select("requested_id", F.col("m").isNotNull().alias("found"), *cols)


def candidates(models: DataFrame, metrics: DataFrame) -> DataFrame:
    """Resolved models with their benchmark metrics, null where a model has none."""
    return models.join(metrics.withColumnRenamed("model_id", "resolved_id"), "resolved_id", "left")


def benchmark_report(models: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row per model: the seven leaderboard metrics of its newest result, null where it has none."""
    parsed = payloads.select("model_id", *[x.alias(k) for k, x in leaderboard_metrics(F.col("payload")).items()])
    return models.select("model_id").join(parsed, "model_id", "left")


def license_report(datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approved and rejected datasets, each with its rationale."""
    judged = datasets.withColumn("license_rationale", license_decision(F.col("license")))
    ok = F.col("license_rationale") == "approved"
    return judged.filter(ok), judged.filter(~ok)


def literature(found: DataFrame, key: str = "id") -> DataFrame:
    """Papers of all queries that fit their theme, one row each with its queries, newest first.

    Needs query, ordinal and the fields of a feed's entries.
    """
    fits = found.filter(matches_theme(F.col("query"), F.col("title"), F.col("summary")))
    keep = [c for c in found.columns if c not in (key, "query", "ordinal")]
    papers = merge_hits(fits, key, "ordinal", "query", keep)
    return papers.withColumn("relevance", relevance(F.element_at("queries", 1), F.col("summary"))).orderBy(F.desc("published"), key)


def format_metric(x: Column) -> Column:
    """Three decimals, or n/a."""
    return F.coalesce(t.fixed(x.cast("double"), F.lit(3)), F.lit("n/a"))


def winner(ranked: DataFrame) -> DataFrame:
    return ranked.filter("filter_reason IS NULL").orderBy("rank").limit(1)


def merge_hits(hits: DataFrame, key: str, ordinal: str, query: str, keep: list[str]) -> DataFrame:
    """One row per key: metadata of the first hit, all queries in order (repeats stay)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(query).alias("q"))))
    out = hits.groupBy(key).agg(F.min_by(F.struct(*keep), F.col(ordinal)).alias("m"), F.transform(pairs, lambda p: p["q"]).alias("queries"))
    return out.select(key, "m.*", "queries")


def latest_result(paths: DataFrame, path: str = "path") -> DataFrame:
    """Newest result file of each model: the largest path."""
    model = F.regexp_extract(path, r"^(.+)/results_.*\.json$", 1)
    return paths.withColumn("model", model).filter("model <> ''").groupBy("model").agg(F.max(path).alias("path"))


def matches_theme(query: Column, title: Column, summary: Column) -> Column:
    hay = F.lower(F.concat(title, F.lit(" "), summary))
    q = F.lower(query)
    need = F.lit(True)
    for triggers, required in reversed(THEMES):
        need = F.when(_any(q, triggers), _any(hay, required)).otherwise(need)
    return need & ~_any(hay, BANNED)


def eq_score(text: Column) -> Column:
    """First number after EQ-Bench, over 100 when above 1, within 0 and 1."""
    x = F.regexp_extract(text, r"(?is)EQ[- ]?Bench.*?([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    return F.when(x.isNotNull(), F.least(F.greatest(F.when(x > 1, x / 100).otherwise(x), F.lit(0.0)), F.lit(1.0)))


def query_terms(query: Column) -> Column:
    """First five distinct words of three characters or more, as a conjunction."""
    words = F.filter(F.split(F.lower(query), "[^a-z0-9]+"), lambda w: F.length(w) >= 3)
    return F.array_join(F.transform(F.slice(F.array_distinct(words), 1, 5), lambda w: F.concat(F.lit("all:"), w)), " AND ")


def leaderboard_metrics(payload: Column) -> dict[str, Column]:
    """Seven metrics of a nested result; missing ones null."""
    return {
        name: F.get_json_object(payload, f"$.results.{group}['{field}']").try_cast("double") for name, (group, field) in METRIC_PATHS.items()
    }


# Words of a query, or at last of a summary, and what they stand for.
RELEVANCE = [
    (["emotion", "motivation"], "emotionally aware responses in moments of dropout risk"),
    (["memory", "personalization"], "continuity for the single user"),
    (["retrieval", "hallucination"], "trust through safer, better grounded advice"),
]


def relevance(query: Column, summary: Column) -> Column:
    """Why a paper matters for retention: the first rule that fits its query, then its summary."""
    q, out = F.lower(query), None
    for words, text in RELEVANCE:
        out = F.when(_any(q, words), text) if out is None else out.when(_any(q, words), text)
    return out.when(F.contains(F.lower(summary), F.lit("coaching")), "how to coach rather than only answer").otherwise("model behavior or grounding")


def next_number(decisions: Column) -> Column:
    """Largest decision number of a log plus one."""
    numbers = F.transform(F.regexp_extract_all(decisions, F.lit(r"## Decision ([0-9]+):"), F.lit(1)), lambda x: x.cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(0)) + 1
