"""The stages end to end, from files to files: clean, score, compose and split, generate and package.

Tables are written as JSON lines, reports as small JSON and Markdown files
beside them. What comes to the driver is counts and rates.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.lexicon import STOCK, Lexicon
from ..operators import audit, clean, compose, score, split
from ..sources import readers, sinks
from ..sources.store import exists
from . import planner, profile, rubric as rb

MESSAGES = "array<struct<role:string,content:string>>"
CLEANED = (
    "conversation_id string, dataset_id string, source_license string, source_file string, source_record_index bigint, turn_count int, user_turn_count int, assistant_turn_count int, "
    f"contains_system_message boolean, language_hint string, conversation_characters int, normalized_sha256 string, quality_flags array<string>, messages {MESSAGES}"
)
SCORES = (
    "topic_tags array<string>, domain_relevance_score double, coaching_signal_score double, specificity_score double, emotional_acknowledgment_score double, cliche_penalty double, "
    "safety_penalty double, repetition_penalty double, overall_quality_score double, exclusion_reasons array<string>, passes_training_filter boolean"
)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _rows(df: DataFrame) -> list[dict]:
    """A report's rows."""
    return [r.asDict(recursive=True) for r in df.collect()]


def _json(spark: SparkSession, path: str, body: dict) -> str:
    return sinks.write_text(spark, path, sinks.report_json({"generated_at": _now()} | body))


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.replace("struct<role:string,content:string>", "x").split(", ")]


def clean_corpus(spark: SparkSession, manifest: str, out: str, report: str, dataset_ids: list[str] | None = None) -> tuple[str, str]:
    """Raw files of a manifest to cleaned conversations and a report; nothing kept is an error."""
    raw = clean.extract(readers.read_manifest(spark, manifest, dataset_ids))
    done = clean.clean(raw)
    sinks.write_jsonl(clean.kept(done).select(*_names(CLEANED)), out)
    counts = _rows(clean.report(done))
    body = {
        "totals": next((r for r in counts if r["dataset_id"] is None), {}),
        "datasets": [r for r in counts if r["dataset_id"] is not None],
        "counters": _rows(clean.counters(done)),
        "files": _rows(readers.manifest_report(readers.manifest_files(spark, manifest, dataset_ids))),
    }
    _json(spark, report, body)
    if not body["totals"].get("kept_records"):
        raise RuntimeError("no record was kept")
    return out, report


def score_corpus(spark: SparkSession, cleaned: str, out: str, report: str, lex: Lexicon = STOCK) -> tuple[str, str]:
    """Cleaned conversations to scored ones and a report."""
    done = score.score(spark.read.schema(CLEANED).json(cleaned), lex)
    sinks.write_jsonl(done.select(*_names(CLEANED), *_names(SCORES)), out)
    done = spark.read.schema(f"{CLEANED}, {SCORES}").json(out)
    counts = {name: _rows(score.label_counts(done, name)) for name in ("topic_tags", "exclusion_reasons", "quality_flags")}
    counts["language_hint"] = _rows(done.groupBy(F.col("language_hint").alias("label")).agg(F.count(F.lit(1)).alias("n")))
    _json(spark, report, {"report": _rows(score.report(done))[0], "counts": counts})
    return out, report


def build_final(
    spark: SparkSession,
    scored: str,
    root: str,
    synthetic: str | None = None,
    augmented: str | None = None,
    seed: int = 42,
    least: tuple[int, int, int] = (10_000, 500, 500),
    fitness_sources: tuple[str, ...] = (),
    mental_sources: tuple[str, ...] = (),
    base_model: str = "",
) -> dict[str, str]:
    """Passing records, synthetic and augmented ones to the final dataset, its splits, audit, spot check, manifest, card and readiness report."""
    real = spark.read.schema(f"{CLEANED}, {SCORES}").json(scored).filter("passes_training_filter")
    parts = [compose.training_records(real, "real", list(mental_sources))]
    for path, kind in ((synthetic, "synthetic"), (augmented, "augmented")):
        if path:
            parts.append(compose.training_records(readers.read_optional(spark, path, kind).withColumnRenamed("conversations", "messages"), kind, list(mental_sources)))
    rows = compose.union_all(*parts)
    rows = rows.withColumn("bucket", compose.bucket(F.col("topic_tags"), F.col("dataset_id"), list(fitness_sources)))
    final = compose.cap_emotional(rows, seed, "record_id").drop("bucket")
    at = {k: f"{root.rstrip('/')}/{k}" for k in ("dataset", "train", "val", "test")}
    sinks.write_jsonl(final, at["dataset"])
    final = spark.read.schema(final.schema).json(at["dataset"])
    n = final.count()
    to = split.targets(n, least=least)
    ratios = (to.validation / n, to.test / n)
    dealt = split.stratified(final, to, ratios, seed, "record_id")
    for name, label in (("train", "train"), ("val", "validation"), ("test", "test")):
        sinks.write_jsonl(dealt.filter(F.col("split") == label).drop("split"), at[name])
    at["audit"] = f"{root}/composition_audit.json"
    checks = audit.checks(final)
    dims = {name: {r["label"]: r["count"] for r in _rows(audit.distribution(final, name))} for name in ("language", "domain", "source_id")}
    found = _rows(checks)
    _json(spark, at["audit"], {"records": n, "checks": found, "distributions": dims})
    at["spot_check"] = f"{root}/spot_check.json"
    spot = split.spot_check(final, seed=seed)
    spotted = _rows(spot)[0]
    _json(spark, at["spot_check"], spotted)
    at["manifest"] = f"{root}/manifest.json"
    _json(spark, at["manifest"], sinks.final_manifest(spark, root, at["dataset"], {k: at[k] for k in ("train", "val", "test")}, at["audit"], at["spot_check"], base_model))
    at["card"] = f"{root}/dataset_card.md"
    sizes = {"Train": to.train, "Val": to.validation, "Test": to.test}
    titles = {"Language distribution": dims["language"], "Domain distribution": dims["domain"], "Source contribution": dims["source_id"]}
    sinks.write_text(spark, at["card"], sinks.shares("Final dataset", n, sizes, titles))
    at["readiness"] = f"{root}/readiness.md"
    verdict = _rows(audit.blockers(checks, spot))[0]
    low, high = (spark.range(1).select(*profile.runtime_hours(F.lit(to.train), F.lit(float(spotted["avg_tokens"] or 0)))).first())
    sections = {"Verdict": [verdict], "Checks": found, "Spot check": [spotted], "Runtime": [{"hours_low": low, "hours_high": high}]}
    sinks.write_text(spark, at["readiness"], sinks.markdown("Training readiness", sections))
    return at


def statistics(staged: planner.Staging) -> dict:
    """Counts, rates and scores of what was accepted, and how far its distributions are from the plan's."""
    spark, rows = staged.spark, staged.rows()
    log = staged.rejected()
    judged = rows.select("slot", "candidate").withColumn("rejection", F.lit(None).cast("string")).unionByName(log)
    verdicts = planner.scored(rows)
    passed = _rows(verdicts.agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("k")))[0]
    detailed = rb.rubric(rb.validators(planner.demands(rows, STOCK), STOCK))
    plan = planner.detailed(planner.candidate_plan(spark, staged.target, staged.seed))
    counts = lambda df, dims: {d: {r["label"]: r["n"] for r in _rows(planner.distributions(df, [d]))} for d in dims}
    actual, planned = counts(rows, planner.ACCEPTED), counts(plan, planner.PLANNED)
    away = lambda d: _rows(audit.max_deviation(_table(spark, actual[d]), _table(spark, planned[d])))[0]["max_deviation"]
    return {
        "sample_count": passed["n"],
        "rejected_count": log.count(),
        "retry_count": log.count(),
        "rates": _rows(planner.rates(judged))[0],
        "validator_pass_rate": passed["k"] / passed["n"] if passed["n"] else 0.0,
        "rejections": {r["rejection"]: r["n"] for r in _rows(log.groupBy("rejection").agg(F.count(F.lit(1)).alias("n")))},
        "quality_score_statistics": {r["validator"]: r for r in _rows(audit.validator_stats(rb.long_scores(detailed, "slot")))},
        "score_histogram": {r["bucket"]: r["n"] for r in _rows(audit.histogram(detailed, "overall_score"))},
        "distributions": actual,
        "planned_distributions": planned,
        "persona_deviation": away("persona_id"),
        "scenario_deviation": away("scenario_id"),
    }


def _table(spark: SparkSession, counts: dict) -> DataFrame:
    return spark.createDataFrame([(str(k), int(n)) for k, n in counts.items()], "label string, n bigint")


def generate(spark: SparkSession, root: str, target: int, seed: int, batch_size: int = 25, max_batches: int | None = None) -> dict[str, str]:
    """The production corpus: staged in batches, resumed where it stopped, packaged when the target is reached.

    A gate that fails writes the report and stops before anything is exported.
    """
    at = {"staging": f"{root}/staging", "rejections": f"{root}/staging-rejected"}
    staged = planner.Staging(spark, at["staging"], seed, target)
    if staged.run(batch_size, max_batches) < target:
        return at
    stats = statistics(staged)
    at |= {k: f"{root}/{v}" for k, v in {"train": "train", "statistics": "statistics.json", "card": "card.md", "report": "report.md", "manifest": "manifest.json"}.items()}
    row = [(stats["validator_pass_rate"], stats["rates"]["duplicate_rate"], stats["persona_deviation"], stats["scenario_deviation"])]
    measured = spark.createDataFrame(row, "validator_pass_rate double, duplicate_rate double, persona_deviation double, scenario_deviation double")
    gates = _rows(audit.gates(measured, _table(spark, stats["distributions"]["memory_category"]).select("n")))
    sections = {
        "Counts": [{k: stats[k] for k in ("sample_count", "rejected_count", "retry_count", "validator_pass_rate")} | stats["rates"]],
        "Quality gates": gates,
        "Validators": list(stats["quality_score_statistics"].values()),
        "Histogram": [{"bucket": k, "n": n} for k, n in stats["score_histogram"].items()],
        "Rejections": [{"reason": k, "n": n} for k, n in stats["rejections"].items()],
    }
    sinks.write_text(spark, at["report"], sinks.markdown("Production corpus", sections))
    failed = [g["gate"] for g in gates if g["status"] != "PASS"]
    if failed:
        raise RuntimeError(f"gates failed: {failed}; see {at['report']}")
    rows = staged.rows()
    records = compose.training_records(rows.withColumns({"record_id": F.format_string("synthetic-%06d", "slot"), "dataset_id": F.lit("synthetic")}), "synthetic")
    factory = F.struct("seed", "target", "slot", "candidate").alias("factory_metadata")
    own = planner.assembled(rows).select(F.format_string("synthetic-%06d", "slot").alias("record_id"), F.struct("conversation_id", "persona", "profile", "memory", "scenario", "quality").alias("synthetic_metadata"))
    keyed = rows.select(F.format_string("synthetic-%06d", "slot").alias("record_id"), factory)
    sinks.write_jsonl(records.join(own, "record_id").join(keyed, "record_id").orderBy("record_id"), at["train"])
    _json(spark, at["statistics"], sinks.self_checked(stats))
    titles = {d: stats["distributions"][d] for d in ("persona_id", "scenario_id", "memory_category", "history_length")}
    sinks.write_text(spark, at["card"], sinks.shares("Synthetic corpus", stats["sample_count"], {"Rejected": stats["rejected_count"]}, titles))
    _json(spark, at["manifest"], sinks.package_manifest(spark, root, {k: at[k] for k in ("train", "statistics", "card", "report")}, stats["sample_count"], stats))
    return at


def pilot(spark: SparkSession, root: str, target: int = 100, seed: int = 42) -> dict[str, str]:
    """The first conversations that pass of up to three times as many, and a report; fewer are an error."""
    most = max(3 * target, 120)
    made = planner.scored(planner.generate(planner.candidate_plan(spark, most, seed)))
    rows = planner.pilot(made, target, F.col("passed"))
    at = {"dataset": f"{root}/pilot", "report": f"{root}/pilot.md"}
    sinks.write_jsonl(planner.assembled(rows), at["dataset"])
    sinks.write_text(spark, at["report"], sinks.markdown("Pilot", {"Statistics": _rows(profile.pilot_statistics(rows))}))
    return at


def base_model(spark: SparkSession, chosen: str, decisions: str, default: str) -> str:
    """The model a file names, else the last one that the decision log names, else the default."""
    if exists(spark, chosen):
        name = json.loads(sinks.read_text(spark, chosen)).get("model_id")
        if name:
            return name
    if exists(spark, decisions):
        text = spark.read.text(decisions, wholetext=True)
        found = text.select(F.try_element_at(F.regexp_extract_all("value", F.lit(r"Selected base model: `([^`]+)`"), F.lit(1)), F.lit(-1))).first()
        if found and found[0]:
            return found[0]
    return default
