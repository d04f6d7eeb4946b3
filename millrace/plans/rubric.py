"""The ten validators of a synthetic conversation and the weighted rubric over them.

Rows need: response, final_user, topic_tags, domain_score (see
``operators.score``), facts, constraints, keywords, references (facts and usage
mode), principles, follow_ups, and the flags named below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scoring as s, text as t
from ..functions.plan import once
from ..functions.lexicon import RAW_FIELDS, RISKY_CLAIMS, Lexicon

# Weight and floor of each validator, and the overall floor.
VALIDATORS = {
    "empathy": (0.12, 0.70),
    "coaching_quality": (0.12, 0.70),
    "personalization": (0.10, 0.70),
    "behavioral_adaptation": (0.10, 0.65),
    "scientific_consistency": (0.12, 0.75),
    "long_term_memory_usage": (0.12, 0.70),
    "follow_up_questioning": (0.08, 0.60),
    "hallucination_detection": (0.10, 0.85),
    "repetitive_responses": (0.06, 0.75),
    "scenario_consistency": (0.08, 0.75),
}
OVERALL = 0.75


def profile_facts(*parts: Column) -> Column:
    """Ordered distinct facts, stripped and lower case; each part an array."""
    flat = F.transform(F.flatten(F.array(*parts)), lambda x: F.lower(t.strip(x)))
    return F.array_distinct(F.filter(flat, lambda x: x.isNotNull() & (x != "")))


def _ratio(hits: Column, pool: Column, most: int) -> Column:
    return hits / F.greatest(F.lit(1), F.least(F.size(pool), F.lit(most)))


def validators(df: DataFrame, lex: Lexicon) -> DataFrame:
    """Add the ten scores; what several of them look at is computed once."""
    r, one = F.col("response"), F.lit(1.0)
    df = once(df, __f=t.fold(r), __user=t.fold(F.col("final_user")), __said=t.sentences(F.coalesce("response", F.lit(""))))
    df = once(df, __safety=s.safety_penalty(F.col("__f"), lex))
    f, said, safety = F.col("__f"), F.col("__said"), F.col("__safety")
    no_feelings = F.coalesce(F.col("no_emotional_objectives"), F.lit(False))
    empathy = F.when(no_feelings, F.when(t.strip(r) != "", one).otherwise(0.0)).otherwise(s.acknowledgement(r, f))
    coaching = (
        s.coaching_signal(r, f, lex) * 0.40
        + s.specificity(r, lex, said) * 0.35
        + (one - F.least(safety / 0.20, one)) * 0.15
        + (one - F.least(s.cliche_penalty(f, lex) / 0.10, one)) * 0.10
    )
    adapted = F.coalesce(F.col("has_adaptation_summary"), F.lit(False))
    constraints = F.concat(
        F.col("constraints"),
        F.when(F.col("stress") == "high", F.array(F.lit("stress"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("sleep_hours") < 6.0, F.array(F.lit("sleep"))).otherwise(F.array().cast("array<string>")),
    )
    base = F.when(adapted, F.lit(0.5)).otherwise(F.lit(0.0))
    hits = F.least(_ratio(t.count_contained(f, constraints), constraints, 2), one)
    adaptation = F.when(F.size(constraints) > 0, base + hits * 0.5).otherwise(F.when(adapted, one).otherwise(F.lit(0.5)))
    science = F.least(F.col("principles") / 2.0, one) * 0.35 + (one - F.least(safety / 0.20, one)) * 0.35 + F.col("domain_score") * 0.30
    refs = F.col("references")
    known = lambda x: F.exists(x["facts"], lambda p: (t.strip(p) != "") & F.contains(f, t.fold(p)))
    matched = F.size(F.filter(refs, known)) / F.nullif(F.size(refs), F.lit(0))
    avoided = F.size(F.filter(refs, lambda x: (x["mode"] == "avoid") & known(x)))
    memory = matched - F.when(t.contains_any(f, RAW_FIELDS), F.lit(0.5)).otherwise(F.lit(0.0)) - avoided * 0.25
    memory = F.when(F.size(refs) > 0, memory).when(F.col("must_use_memory"), F.lit(0.0)).otherwise(one)
    need = F.greatest(F.col("required_follow_ups"), F.col("scenario_follow_ups"))
    follow = F.when(need == 0, one).otherwise(F.col("follow_ups") / F.nullif(need, F.lit(0)))
    claims = F.size(F.filter(F.array(*map(F.lit, RISKY_CLAIMS)), lambda p: F.contains(f, p)))
    user = F.col("__user")
    injury = F.col("injury_domain") | F.contains(user, F.lit("pain")) | F.contains(user, F.lit("injury"))
    careless = injury & F.col("has_injury") & ~F.contains(f, F.lit("pain")) & ~F.contains(f, F.lit("modify"))
    truth = one - claims * 0.20 - F.when(careless, F.lit(0.20)).otherwise(F.lit(0.0))
    repeat = one - F.least(s.repetition_penalty(r, said) / 0.15, one)
    pool = F.col("keywords")
    scenario = F.least(_ratio(t.count_contained(f, pool), pool, 3), one) * 0.60 + F.col("domain_score") * 0.40
    personal = _ratio(t.count_contained(f, F.col("facts")), F.col("facts"), 4)
    scores = dict(zip(VALIDATORS, (empathy, coaching, personal, adaptation, science, memory, follow, truth, repeat, scenario), strict=True))
    return once(df, **{k: t.clamp(v) for k, v in scores.items()}).drop("__f", "__user", "__said", "__safety")


def rubric(df: DataFrame, must_pass: Column | None = None) -> DataFrame:
    """Add overall_score, blockers and passed to rows with the ten scores."""
    total, top = sum(w for w, _ in VALIDATORS.values()), F.lit(0.0)
    for name, (weight, _) in VALIDATORS.items():
        top = top + F.col(name) * weight
    df = df.withColumn("overall_score", t.clamp(top / F.lit(total)))
    below = [F.when(F.col(n) < floor, F.lit(f"{n} below {floor:.2f}")) for n, (_, floor) in VALIDATORS.items()]
    blockers = F.array_compact(F.array(*below, F.when(F.col("overall_score") < OVERALL, f"overall below {OVERALL:.2f}")))
    if must_pass is not None:
        passed = F.array_compact(F.array(*[F.when(F.col(n) >= floor, F.lit(n)) for n, (_, floor) in VALIDATORS.items()]))
        failing = F.transform(F.array_except(must_pass, passed), lambda n: F.concat(F.lit("required "), n))
        blockers = F.concat(blockers, failing)
    return df.withColumn("blockers", blockers).withColumn("passed", F.size("blockers") == 0)


def long_scores(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, validator, score), rounded to 4 digits."""
    pairs = F.array(*[F.struct(F.lit(n).alias("validator"), F.bround(n, 4).alias("score")) for n in VALIDATORS])
    return df.select(key, F.explode(pairs).alias("p")).select(key, "p.*")
