"""A PySpark-native engine for curating conversational training corpora."""

from .plans.pipelines import base_model, build_final, clean_corpus, generate, pilot, score_corpus
from .plans.planner import accept, candidate_plan, scored
from .plans.profile import Settings
from .plans.rubric import OVERALL, VALIDATORS, rubric, validators
from .sources.corpora import approved, raw_manifest
from .sources.dimensions import memory_specs, personas, require, scenarios

__all__ = [
    "OVERALL",
    "VALIDATORS",
    "Settings",
    "accept",
    "approved",
    "base_model",
    "build_final",
    "candidate_plan",
    "clean_corpus",
    "generate",
    "memory_specs",
    "personas",
    "pilot",
    "raw_manifest",
    "require",
    "rubric",
    "scenarios",
    "score_corpus",
    "scored",
    "validators",
]
