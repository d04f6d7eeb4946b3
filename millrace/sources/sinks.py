"""Writers and manifests."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """An object per line, ASCII only (other characters as escapes), nulls written out."""
    df.write.mode(mode).option("writeNonAsciiCharacterAsCodePoint", "true").option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """The same behind what is there, keys in order."""
    write_jsonl(df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]), path, "append")


def record_count(spark: SparkSession, path: str) -> int:
    """Lines that are not blank."""
    return spark.read.text(path).filter(F.trim("value") != "").count()


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """A small file as a whole, on any file system."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def read_text(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path, wholetext=True).first()
    return row["value"] if row else ""


def report_json(row: dict) -> str:
    """Indented, ASCII only."""
    return json.dumps(row, indent=2, ensure_ascii=True, default=str)


def self_checked(payload: dict) -> dict:
    """The payload with the SHA-256 of its canonical JSON."""
    canonical = json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=True, default=str)
    return payload | {"content_sha256": hashlib.sha256(canonical.encode()).hexdigest()}


def file_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """Path, size and SHA-256 of the files below a directory, caches left out."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    rel = F.regexp_replace("path", r"^[a-z]+:/+", "/")
    return (
        df.filter(~F.col("path").rlike(r"/(\.cache|__pycache__)/"))
        .select(rel.alias("path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
        .orderBy("path")
    )


def manifest_totals(files: DataFrame, by: str | None = None) -> DataFrame:
    grouped = files.groupBy(by) if by else files.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows and a digest that does not depend on their order or on how files are cut.

    The digest is the sum of 32-bit pieces of the rows' SHA-256, so that it
    combines before the shuffle.
    """
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    piece = lambda i: F.sum(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", *[piece(i).cast("string") for i in range(4)]), 256).alias("fingerprint"))


def artifact(spark: SparkSession, path: str, root: str, records: int | None = None) -> dict:
    """Manifest entry of an output: path below ``root``, bytes, one digest over its files' digests, records."""
    files = file_manifest(spark, path).filter(~F.col("path").rlike(r"/[._][^/]*$"))
    parts = files.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("h")).first()
    entry = {"path": path.removeprefix(root.rstrip("/") + "/"), "size_bytes": parts["n"], "sha256": parts["h"]}
    return entry if records is None else entry | {"sample_count": records}


def final_manifest(spark: SparkSession, root: str, dataset: str, splits: dict[str, str], audit: str, spot_check: str, base_model: str) -> dict:
    """Digests and counts of the final dataset and its splits, and where the reports are."""
    entry = lambda p: artifact(spark, p, root, record_count(spark, p))
    below = lambda p: p.removeprefix(root.rstrip("/") + "/")
    return {
        "manifest_version": 1,
        "project_root": root,
        "base_model_id": base_model,
        "final_dataset": entry(dataset),
        "splits": {name: entry(p) for name, p in splits.items()},
        "composition_audit": below(audit),
        "spot_check_report": below(spot_check),
    }


def package_manifest(spark: SparkSession, root: str, paths: dict[str, str], records: int, statistics: dict) -> dict:
    """Digests of a package's artefacts, with the figures that describe it."""
    return {
        "schema_version": 1,
        "sample_count": records,
        "artifacts": {name: artifact(spark, p, root, records) for name, p in paths.items()},
        "distributions": statistics.get("distributions", {}),
        "validator_pass_rate": statistics.get("validator_pass_rate"),
        "quality_score_statistics": statistics.get("quality_score_statistics", {}),
    }


def shares(title: str, total: int, parts: dict[str, int], sections: dict[str, dict[str, int]]) -> str:
    """A dataset card: sizes, then each distribution with percentages."""
    lines = [f"# {title}", "", f"- Total records: {total}", *[f"- {k}: {n}" for k, n in parts.items()]]
    for name, counts in sections.items():
        lines += ["", f"## {name}", ""]
        lines += [f"- {label}: {n} ({100 * n / total if total else 0.0:.2f}%)" for label, n in sorted(counts.items(), key=lambda x: str(x[0]))]
    return "\n".join(lines) + "\n"


def markdown(title: str, sections: dict[str, list[dict]]) -> str:
    """A report of small tables."""
    lines = [f"# {title}", ""]
    for name, rows in sections.items():
        lines += [f"## {name}", ""]
        if rows:
            cols = list(rows[0])
            lines += ["| " + " | ".join(cols) + " |", "|" + " --- |" * len(cols)]
            lines += ["| " + " | ".join(str(r[c]) for c in cols) + " |" for r in rows]
        else:
            lines.append("none")
        lines.append("")
    return "\n".join(lines)
