"""Command lines: ``python -m millrace <stage> ...``."""

from __future__ import annotations

import argparse
import json


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description="Curate conversational training corpora with Spark.")
    stages = top.add_subparsers(dest="stage", required=True)
    p = stages.add_parser("download", help="snapshots of approved datasets and the raw manifest")
    p.add_argument("--approved-report", required=True)
    p.add_argument("--raw-dir", required=True)
    p.add_argument("--manifest", required=True)
    p.add_argument("--dataset-id", action="append", dest="dataset_ids")
    p.add_argument("--force", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p = stages.add_parser("clean", help="raw files to cleaned conversations")
    p.add_argument("--raw-manifest", required=True)
    p.add_argument("--dataset-id", action="append", dest="dataset_ids")
    p.add_argument("--output-path", required=True)
    p.add_argument("--report-path", required=True)
    p = stages.add_parser("score", help="cleaned conversations to scored ones")
    p.add_argument("--cleaned-dataset", required=True)
    p.add_argument("--output-path", required=True)
    p.add_argument("--report-path", required=True)
    p = stages.add_parser("final", help="scored conversations to the final dataset and its splits")
    p.add_argument("--scored-dataset", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--synthetic")
    p.add_argument("--augmented")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--least", type=int, nargs=3, default=(10_000, 500, 500), metavar=("TRAIN", "VAL", "TEST"))
    p = stages.add_parser("synthetic", help="generate conversations")
    p.add_argument("--root", required=True)
    p.add_argument("--pilot", action="store_true")
    p.add_argument("--target-count", type=int)
    p.add_argument("--batch-size", type=int)
    p.add_argument("--max-batches", type=int)
    p.add_argument("--seed", type=int, default=20260710)
    return top


def no_download(dataset: str, directory: str, force: bool) -> None:
    raise RuntimeError(f"put the files of {dataset} into {directory}; nothing is fetched from here")


def run(argv: list[str] | None = None, spark=None, download=no_download) -> dict:
    """Run one stage; returns what was written, by name."""
    args = parser().parse_args(argv)
    if args.stage == "synthetic" and args.pilot and (args.target_count or args.batch_size or args.max_batches):
        raise ValueError("batch controls apply to the production corpus only")
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("millrace").getOrCreate()
    from .plans import pipelines
    from .sources import corpora, sinks

    if args.stage == "download":
        body = corpora.raw_manifest(spark, args.approved_report, args.raw_dir, download, args.dataset_ids, args.force, args.dry_run)
        return {"manifest": sinks.write_text(spark, args.manifest, json.dumps(body, indent=2))}
    if args.stage == "clean":
        return dict(zip(("output", "report"), pipelines.clean_corpus(spark, args.raw_manifest, args.output_path, args.report_path, args.dataset_ids), strict=True))
    if args.stage == "score":
        return dict(zip(("output", "report"), pipelines.score_corpus(spark, args.cleaned_dataset, args.output_path, args.report_path), strict=True))
    if args.stage == "final":
        return pipelines.build_final(spark, args.scored_dataset, args.root, args.synthetic, args.augmented, args.seed, tuple(args.least))
    if args.pilot:
        return pipelines.pilot(spark, args.root, seed=args.seed)
    return pipelines.generate(spark, args.root, args.target_count or 250, args.seed, args.batch_size or 25, args.max_batches)


def main(argv: list[str] | None = None) -> int:
    for path in run(argv).values():
        print(path)
    return 0
