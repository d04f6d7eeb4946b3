"""Personas, scenarios and memory specifications as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Persona, age, lifestyle, experience, motivation, diet, stress, injury.
PERSONAS = [
    ("student_beginner_exam_stress", 20, "student", "beginner", "confidence", "vegetarian", "high", None),
    ("busy_fat_loss_professional", 37, "office_worker", "novice", "health", "flexible", "moderate", "intermittent low-back tightness"),
    ("muscle_gain_new_parent", 31, "parent", "intermediate", "aesthetics", "high_protein", "high", None),
    ("traveling_sales_runner", 29, "frequent_traveler", "intermediate", "performance", "omnivore", "moderate", "mild right Achilles irritation"),
    ("returning_after_break_creative", 27, "creative_freelancer", "novice", "routine", "flexible", "moderate", None),
    ("shift_worker_recovery_focus", 34, "shift_worker", "novice", "stress_relief", "omnivore", "high", "recurring neck and upper-back tension"),
    ("retiree_general_fitness", 64, "retiree", "beginner", "health", "omnivore", "low", "knee stiffness when descending stairs"),
    ("vegan_body_recomp_office_worker", 26, "office_worker", "intermediate", "aesthetics", "vegan", "moderate", None),
    ("competition_prep_advanced", 28, "creative_freelancer", "advanced", "performance", "high_protein", "moderate", None),
    ("muscle_gain_student_confidence_building", 22, "student", "novice", "confidence", "omnivore", "moderate", None),
]
# Scenario, domains, allowed memory events, follow-up questions, keywords.
SCENARIOS = [
    ("beginner_onboarding", "general_fitness adherence", "goal_set schedule_changed", 2, "start,simple,week,gym,confidence"),
    ("fat_loss_planning", "fat_loss nutrition", "goal_set nutrition_target_set", 1, "protein,calories,steps,consistent"),
    ("muscle_gain_support", "muscle_gain nutrition", "goal_set personal_record_set", 1, "progressive,protein,surplus,recovery"),
    ("plateau_review", "adherence general_fitness", "plateau_identified sleep_pattern_changed", 2, "plateau,recovery,adherence,adjust"),
    ("missed_workouts_reset", "adherence", "workout_missed stress_elevated", 1, "restart,next workout,small step,consistency"),
    ("injury_recovery_adjustment", "injury_recovery recovery", "injury_reported medical_note_added", 2, "pain,modify,range,assessment"),
    ("poor_sleep_recovery", "recovery adherence", "sleep_pattern_changed stress_elevated", 1, "sleep,fatigue,reduce,recovery"),
    ("exam_stress_adjustment", "adherence recovery", "stress_elevated schedule_changed", 1, "exam,stress,short sessions,momentum"),
    ("travel_continuity", "adherence general_fitness", "travel_started schedule_changed", 1, "travel,hotel,bodyweight,routine"),
    ("busy_professional_compliance", "adherence general_fitness", "schedule_changed stress_elevated", 1, "schedule,efficient,minimum effective,prioritize"),
    ("returning_after_break", "general_fitness adherence", "program_changed workout_missed", 1, "return,gradual,baseline,rebuild"),
    ("competition_preparation", "muscle_gain recovery", "program_changed deload_started personal_record_set", 2, "prep,specificity,fatigue,peak"),
]
# Memory event, category, priority.
MEMORY = [
    ("goal_set", "goal", "high"),
    ("schedule_changed", "schedule", "high"),
    ("workout_missed", "readiness", "medium"),
    ("injury_reported", "health", "high"),
    ("sleep_pattern_changed", "readiness", "medium"),
    ("travel_started", "context", "medium"),
    ("nutrition_target_set", "nutrition", "medium"),
    ("stress_elevated", "readiness", "medium"),
]
# All event types of the log.
EVENT_TYPES = (
    "weight_recorded body_fat_recorded measurements_recorded goal_set goal_changed goal_achieved workout_completed workout_missed "
    "personal_record_set program_changed deload_started deload_ended nutrition_target_set nutrition_target_updated diet_changed "
    "supplement_started supplement_stopped injury_reported injury_recovered sleep_pattern_changed medical_note_added travel_started "
    "travel_ended schedule_changed stress_elevated stress_resolved milestone_celebrated plateau_identified plateau_resolved coach_note_added"
).split()


def personas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PERSONAS, "persona_id string, age int, lifestyle string, experience string, motivation string, diet string, stress string, injury string"
    )


def scenarios(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame(SCENARIOS, "scenario_id string, domains string, allowed string, follow_ups int, keywords string")
    return raw.withColumns({"domains": F.split("domains", " "), "allowed": F.split("allowed", " "), "keywords": F.split("keywords", ",")})


def memory_specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MEMORY, "event_type string, category string, priority string")


def require(rows: DataFrame, key: str, wanted: list[str]) -> None:
    """A library must hold the wanted ids, each once."""
    spark = rows.sparkSession
    want = spark.createDataFrame([(w,) for w in wanted], f"{key} string")
    missing = [r[0] for r in want.join(rows.select(key), key, "left_anti").collect()]
    twice = [r[0] for r in rows.groupBy(key).count().filter("count > 1").select(key).collect()]
    if missing or twice:
        raise ValueError(f"library of {key}: missing {missing}, repeated {twice}")


def lookup(df: DataFrame, library: DataFrame, key: str) -> DataFrame:
    """Join a library that must know every key; Spark broadcasts it where its size allows."""
    known = library.withColumn("__known", F.lit(True))
    joined = df.join(known, key, "left")
    wrong = F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key), F.lit("null"))))
    return joined.withColumn(key, F.when(F.col("__known").isNotNull(), F.col(key)).otherwise(wrong.cast("string"))).drop("__known")
