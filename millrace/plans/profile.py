"""Rule tables of generated conversations: goals, profiles, memory facts, constraints, questions, histories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the rules.
RECOMPOSITION = "vegan_body_recomp_office_worker"
HOTEL, HOME = "hotel gym with dumbbells and a treadmill", "home dumbbells, bench, and bands"
BY_LIFESTYLE = {"retiree": "community gym machines and walking paths", "student": "campus gym machines and treadmills"}
GYM = "commercial gym with free weights and machines"
SCENARIO_INJURY, TRAVEL, EXAMS = "recent shoulder discomfort during pressing", "hotel gym access varies", "exam blocks reduce training time"
FACTS = {
    "workout_missed": "missed last week's planned session",
    "travel_started": TRAVEL,
    "nutrition_target_set": "protein target of 130 grams",
    "stress_elevated": "high work stress",
}


def goal_domain(persona: Column, domains: Column) -> Column:
    """The scenario's first domain; one persona keeps its stated focus."""
    return F.when(persona == RECOMPOSITION, "body_recomposition").otherwise(domains[0])


def equipment(scenario: Column, lifestyle: Column, notes: Column | None = None) -> Column:
    out = F.when(scenario == "travel_continuity", HOTEL)
    if notes is not None:
        out = out.when(F.contains(F.lower(notes), F.lit("home workouts")), HOME)
    for name, value in BY_LIFESTYLE.items():
        out = out.when(lifestyle == name, value)
    return out.otherwise(GYM)


def sleep_hours(scenario: Column, stress: Column) -> Column:
    return (
        F.when(scenario == "poor_sleep_recovery", F.lit(5.5))
        .when(stress == "high", F.lit(5.8))
        .when(stress == "moderate", F.lit(6.8))
        .otherwise(F.lit(7.3))
    )


def injuries(scenario: Column, own: Column) -> Column:
    """The persona's injuries; an injury scenario gives one to those without."""
    return F.when((scenario == "injury_recovery_adjustment") & (F.size(own) == 0), F.array(F.lit(SCENARIO_INJURY))).otherwise(own)


def schedule(scenario: Column, own: Column) -> Column:
    extra = F.when(scenario == "travel_continuity", F.array(F.lit(TRAVEL))).when(scenario == "exam_stress_adjustment", F.array(F.lit(EXAMS)))
    return F.concat(own, F.coalesce(extra, F.array().cast("array<string>")))


def constraints(hurt: Column, plan: Column, food: Column, stress: Column, sleep: Column) -> Column:
    """All constraints in order, blank ones left out; the first two shape a response."""
    some = lambda c, x: F.when(c, F.array(F.lit(x))).otherwise(F.array().cast("array<string>"))
    every = F.concat(hurt, plan, food, some(stress == "high", "stress"), some(sleep < 6.0, "sleep"))
    return F.filter(every, lambda x: F.trim(x) != "")


def two_constraints(every: Column) -> tuple[Column, Column]:
    first = F.coalesce(F.get(every, F.lit(0)), F.lit("the available training window"))
    return first, F.coalesce(F.get(every, F.lit(1)), first)


def memory_fact(event: Column, goal: Column, plan: Column, hurt: Column, sleep: Column) -> Column:
    """The fact a memory event stands for; an event without a rule is an error."""
    out = (
        F.when(event == "goal_set", goal)
        .when(event == "schedule_changed", F.get(plan, F.lit(0)))
        .when(event == "injury_reported", F.get(hurt, F.lit(0)))
        .when(event == "sleep_pattern_changed", F.format_string("averaging %.1f hours of sleep", sleep))
    )
    for name, fact in FACTS.items():
        out = out.when(event == name, fact)
    return out.otherwise(F.raise_error(F.concat(F.lit("no memory rule for "), event)).cast("string"))


def rotated(values: Column, index: Column, k: Column) -> Column:
    """``k`` values from place ``index`` on, round and round."""
    start = (index % F.size(values) + 1).cast("int")
    return F.slice(F.concat(values, values), start, k)


def history(turns: Column, scenario: Column, lifestyle: Column, goal: Column, current: Column, index: Column) -> Column:
    """One, three or five turns that begin and end with the user."""
    say = lambda role, x: F.struct(F.lit(role).alias("role"), x.alias("content"))
    now = say("user", current)
    wish = say("user", F.concat(F.lit("I would like a plan for my "), F.replace(lifestyle, F.lit("_"), F.lit(" ")), F.lit(" days and for "), goal, F.lit(".")))
    first = say("assistant", F.lit("Good, we take a simple start and learn from the first week."))
    cycle = say("user", F.concat(F.lit("Cycle "), (index + 1).cast("string"), F.lit(" is done, and the same things got in the way.")))
    reply = say("assistant", F.lit("Then the next step gets smaller, not longer."))
    return (
        F.when((scenario == "beginner_onboarding") | (turns == 1), F.array(now))
        .when(turns == 5, F.array(wish, first, cycle, reply, now))
        .otherwise(F.array(wish, first, now))
    )


def profiles(pairs: DataFrame) -> DataFrame:
    """Add the profile columns to rows that have a persona's and a scenario's columns."""
    own = F.when(F.col("injury").isNotNull(), F.array("injury")).otherwise(F.array().cast("array<string>"))
    s = F.col("scenario_id")
    df = pairs.withColumns(
        {
            "goal_domain": goal_domain(F.col("persona_id"), F.col("domains")),
            "equipment": equipment(s, F.col("lifestyle")),
            "sleep_hours": sleep_hours(s, F.col("stress")),
            "injuries": injuries(s, own),
            "schedule": schedule(s, F.array().cast("array<string>")),
        }
    )
    none = F.array().cast("array<string>")
    return df.withColumn("constraints", constraints(F.col("injuries"), F.col("schedule"), none, F.col("stress"), F.col("sleep_hours")))


def conversation_error(history_: Column, scenario: Column, quality_scenario: Column, must_use_memory: Column, references: Column, follow_ups: Column, required: Column) -> Column:
    """First broken rule of a synthetic conversation, or null."""
    n = F.size(history_)
    pairs = F.zip_with(F.slice(history_, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(history_, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: a["role"] == b["role"])
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "history_is_empty")
        .when(F.get(history_, F.lit(0))["role"] != "user", "history_must_start_with_user")
        .when(F.element_at(history_, -1)["role"] != "user", "history_must_end_with_user")
        .when(F.exists(pairs, lambda x: x), "history_must_alternate")
        .when(F.exists(history_, lambda x: x["role"] == "system"), "history_holds_system")
        .when(F.exists(history_, lambda x: F.trim(x["content"]) == ""), "history_holds_blank")
        .when(scenario != quality_scenario, "scenario_ids_differ")
        .when(must_use_memory & (F.size(references) == 0), "memory_is_missing")
        .when(F.size(follow_ups) < required, "too_few_follow_ups")
    )


def pilot_statistics(df: DataFrame, messages: str = "messages", response: str = "response") -> DataFrame:
    """One row: conversations, mean messages, exchanges and response characters."""
    n = F.size(messages)
    return df.agg(
        F.count(F.lit(1)).alias("conversations"),
        F.bround(F.avg(n), 2).alias("avg_messages"),
        F.bround(F.avg(n / 2), 2).alias("avg_exchanges"),
        F.bround(F.avg(F.length(response)), 2).alias("avg_response_chars"),
    )


def runtime_hours(samples: Column, average_tokens: Column) -> tuple[Column, Column]:
    """Low and high estimate of an epoch at 900 and 600 tokens a second."""
    tokens = samples * F.greatest(F.lit(1.0), average_tokens)
    return F.bround(tokens / 900.0 / 3600.0, 1), F.bround(tokens / 600.0 / 3600.0, 1)


@dataclass(frozen=True)
class Settings:
    """Settings whose combinations are checked when they are made."""

    train_ratio: float = 0.90
    validation_ratio: float = 0.05
    test_ratio: float = 0.05
    holdout_ratio: float = 0.10
    fp16: bool = False
    bf16: bool = False
    logging_steps: int = 10
    eval_steps: int = 100
    save_steps: int = 100
    save_limit: int = 2
    patience: int = 3

    def __post_init__(self):
        wrong = [
            text
            for bad, text in (
                (abs(self.train_ratio + self.validation_ratio + self.test_ratio - 1.0) > 1e-6, "split ratios must sum to 1"),
                (not 0.0 < self.holdout_ratio < 1.0, "the holdout ratio lies between 0 and 1"),
                (self.fp16 and self.bf16, "fp16 and bf16 exclude each other"),
                (min(self.logging_steps, self.eval_steps, self.save_steps) <= 0, "steps are positive"),
                (self.eval_steps != self.save_steps, "evaluation and save steps are equal"),
                (min(self.save_limit, self.patience) < 1, "limit and patience are at least 1"),
            )
            if bad
        ]
        if wrong:
            raise ValueError("; ".join(wrong))
