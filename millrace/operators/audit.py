"""Audits: distributions, threshold checks, duplicate rates, gates and blockers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values: (check, measure, floor or ceiling, threshold).
CHECKS = [
    ("mostly_ascii_share", "mostly_ascii", "min", 0.60),
    ("majority_non_ascii_share", "majority_non_ascii", "max", 0.40),
    ("mental_health_share", "mental-health-adjacent", "max", 0.35),
    ("off_domain_share", "off-domain", "max", 0.01),
    ("largest_source_share", "largest_source", "max", 0.70),
    ("exact_duplicate_rate", "duplicate_rate", "max", 0.0),
]


def distribution(df: DataFrame, label: str) -> DataFrame:
    """Label, count, share (4 digits) and percentage (2 digits)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    share = F.col("count") / F.col("total")
    return counts.crossJoin(F.broadcast(total)).select(
        "label", "count", F.bround(share, 4).alias("share"), F.bround(share * 100, 2).alias("percentage")
    )


def duplicate_rate(df: DataFrame, digest: str) -> DataFrame:
    """(n - distinct) / n over digests that are not blank; null without any."""
    h = F.when(F.trim(digest) != "", F.col(digest))
    out = df.agg(F.count(h).alias("n"), F.count_distinct(h).alias("distinct"))
    return out.withColumn("duplicate_rate", (F.col("n") - F.col("distinct")) / F.nullif(F.col("n"), F.lit(0)))


def largest_source_share(df: DataFrame, source: str) -> DataFrame:
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("share"))


def checks(df: DataFrame, language: str = "language", domain: str = "domain", source: str = "source_id", digest: str = "normalized_sha256") -> DataFrame:
    """One row per check: measured share, threshold, PASS, FAIL or UNVERIFIED (nothing to measure)."""
    n = F.count(F.lit(1))
    shares = df.agg(
        *[(F.count_if(F.col(language) == x) / n).alias(x) for x in ("mostly_ascii", "majority_non_ascii")],
        *[(F.count_if(F.col(domain) == x) / n).alias(x) for x in ("mental-health-adjacent", "off-domain")],
    )
    largest = largest_source_share(df, source).select(F.col("share").alias("largest_source"))
    wide = shares.crossJoin(F.broadcast(largest)).crossJoin(F.broadcast(duplicate_rate(df, digest).select("duplicate_rate")))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"), F.col(f"`{measure}`").alias("value"), F.lit(kind).alias("kind"), F.lit(limit).alias("threshold")
            )
            for name, measure, kind, limit in CHECKS
        ]
    )
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    return long.withColumn("status", status(F.col("value"), F.col("kind"), F.col("threshold")))


def status(value: Column, kind: Column, threshold: Column) -> Column:
    ok = F.when(kind == "min", value >= threshold).otherwise(value <= threshold)
    return F.when(value.isNull(), "UNVERIFIED").when(ok, "PASS").otherwise("FAIL")


def blockers(checked: DataFrame, spot: DataFrame | None = None) -> DataFrame:
    """One row: failed checks as text and GO, which needs the audit and the spot check to pass."""
    failed = F.when(F.col("status") == "FAIL", F.col("check"))
    out = checked.agg(
        F.array_join(F.array_sort(F.collect_list(failed)), "; ").alias("blockers"), F.count_if(F.col("status") != "PASS").alias("open_checks")
    )
    if spot is not None:
        out = out.crossJoin(F.broadcast(spot.select(F.col("status").alias("spot_status"))))
    else:
        out = out.withColumn("spot_status", F.lit("PASS"))
    go = (F.col("open_checks") == 0) & (F.col("spot_status") == "PASS")
    return out.withColumn("verdict", F.when(go, "GO").otherwise("NO GO"))


def deviation(actual: DataFrame, planned: DataFrame, label: str = "label", n: str = "n") -> DataFrame:
    """Share by label, actual and planned, over the union of labels, with their distance."""
    side = lambda df, name: df.select(F.col(label).alias("label"), F.col(n).alias(name))
    both = side(actual, "a").join(side(planned, "p"), "label", "full")
    both = both.select("label", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("p", F.lit(0)).alias("p"))
    total = both.agg(F.sum("a").alias("ta"), F.sum("p").alias("tp"))
    share = lambda x, t: F.coalesce(F.col(x) / F.nullif(F.col(t), F.lit(0)), F.lit(0.0))
    both = both.crossJoin(F.broadcast(total))
    return both.select(
        "label",
        F.col("a").alias("actual"),
        F.col("p").alias("planned"),
        F.abs(share("a", "ta") - share("p", "tp")).alias("deviation"),
    )


def max_deviation(actual: DataFrame, planned: DataFrame, label: str = "label", n: str = "n") -> DataFrame:
    return deviation(actual, planned, label, n).agg(F.max("deviation").alias("max_deviation"))


#: Thresholds of the production gates.
GATES = {"validator_pass_rate": 1.0, "duplicate_rate": 0.0, "persona_deviation": 0.01, "scenario_deviation": 0.01, "memory_share": 0.40}


def gates(stats: DataFrame, memory: DataFrame) -> DataFrame:
    """Five production gates, a row each.

    ``stats``: one row with the first four measures; ``memory``: counts ``n`` by
    memory category, whose largest percentage (two digits) is the fifth.
    """
    total = F.sum("n").over(_all())
    share = memory.withColumn("p", F.bround(F.col("n") / total * 100, 2)).agg(F.coalesce(F.max("p") / 100, F.lit(0.0)).alias("memory_share"))
    wide = stats.crossJoin(F.broadcast(share))
    rows = F.array(
        *[
            F.struct(
                F.lit(g).alias("gate"),
                F.col(g).cast("double").alias("value"),
                F.lit("min" if g == "validator_pass_rate" else "max").alias("kind"),
                F.lit(limit).alias("threshold"),
            )
            for g, limit in GATES.items()
        ]
    )
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    return long.withColumn("status", status(F.col("value"), F.col("kind"), F.col("threshold")))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()


def histogram(scores: DataFrame, score: str) -> DataFrame:
    """Scores in three buckets; the lowest holds everything under 0.80."""
    x = F.col(score)
    bucket = F.when(x < 0.80, "0.75-0.79").when(x < 0.90, "0.80-0.89").otherwise("0.90-1.00")
    return scores.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def validator_stats(long: DataFrame, name: str = "validator", score: str = "score") -> DataFrame:
    """Mean, least and largest score by validator, to 4 digits."""
    return long.groupBy(F.col(name).alias("validator")).agg(
        F.bround(F.avg(score), 4).alias("average"), F.bround(F.min(score), 4).alias("minimum"), F.bround(F.max(score), 4).alias("maximum")
    )
