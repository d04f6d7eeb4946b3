"""Approved datasets, their snapshots on disk and the raw manifest; fetches go through a callable."""

from __future__ import annotations

import json
import re
import urllib.parse
import urllib.request
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sinks import file_manifest, read_text
from .store import exists

APPROVED = "approved array<struct<id:string,license:string,queries:array<string>,downloads:bigint,likes:bigint,last_modified:string,dataset_url:string>>"
PLANNED, DOWNLOADED, REUSED = "planned", "downloaded", "reused_existing"


class FetchError(RuntimeError):
    """A document that could not be fetched."""


def fetch_text(url: str, timeout: float = 30.0, opener: Callable = urllib.request.urlopen) -> str:
    try:
        with opener(url, timeout=timeout) as response:
            return response.read().decode("utf-8")
    except Exception as e:
        raise FetchError(f"{url}: {e}") from e


def fetch_json(url: str, timeout: float = 30.0, opener: Callable = urllib.request.urlopen):
    try:
        return json.loads(fetch_text(url, timeout, opener))
    except json.JSONDecodeError as e:
        raise FetchError(f"{url}: {e}") from e


def storage_name(dataset_id: str) -> str:
    """The directory of a dataset; ``functions.text.storage_name`` is the same on columns."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", dataset_id.replace("/", "__")).strip("._") or "dataset"


def approved(spark: SparkSession, report: str) -> DataFrame:
    """Rows of an approved-dataset report; a missing file, or one without the list, is an error."""
    if not exists(spark, report):
        raise FileNotFoundError(report)
    head = spark.read.text(report, wholetext=True).select(F.try_parse_json("value").alias("v"))
    kind = head.select(F.schema_of_variant(F.try_variant_get("v", "$.approved", "variant"))).first()
    if kind is None or not (kind[0] or "").startswith("ARRAY"):
        raise ValueError(f"malformed report: {report}")
    return spark.read.schema(APPROVED).json(report, multiLine=True).select(F.explode("approved").alias("d")).select("d.*")


def wanted(datasets: DataFrame, dataset_ids: list[str] | None) -> DataFrame:
    """All, or those asked for; none of them there is an error."""
    ids = sorted({i.strip() for i in dataset_ids or [] if i.strip()})
    if not dataset_ids:
        return datasets
    some = datasets.join(datasets.sparkSession.createDataFrame([(i,) for i in ids], "id string"), "id", "left_semi")
    if some.isEmpty():
        raise ValueError(f"no approved dataset of {', '.join(ids)}")
    return some


def has_files(spark: SparkSession, directory: str) -> bool:
    """Whether any file lies below a directory, caches left out."""
    return exists(spark, directory) and not file_manifest(spark, directory).isEmpty()


def raw_manifest(
    spark: SparkSession,
    report: str,
    root: str,
    download: Callable[[str, str, bool], None],
    dataset_ids: list[str] | None = None,
    force: bool = False,
    dry_run: bool = False,
) -> dict:
    """Snapshots of the approved datasets below ``root`` and the manifest of what is there.

    ``download(dataset_id, directory, force)`` fetches one; a directory that
    holds files is reused unless ``force``, and a dry run only plans. A dataset
    that gave no files is an error. Datasets are a library, a few rows.
    """
    rows = wanted(approved(spark, report), dataset_ids).collect()
    if not rows:
        raise ValueError(f"no approved datasets in {report}")
    out = []
    for d in rows:
        at = f"{root.rstrip('/')}/{storage_name(d['id'])}"
        status, files = PLANNED, []
        if not dry_run:
            status = REUSED if not force and has_files(spark, at) else DOWNLOADED
            if status == DOWNLOADED:
                download(d["id"], at, force)
            files = [r.asDict() for r in file_manifest(spark, at).collect()] if exists(spark, at) else []
            if not files:
                raise RuntimeError(f"{d['id']} gave no files in {at}")
        total = sum(f["size_bytes"] for f in files)
        out.append(d.asDict() | {"local_dir": at, "status": status, "file_count": len(files), "total_size_bytes": total, "files": files})
    given = json.loads(read_text(spark, report))
    return {
        "manifest_version": 1,
        "generated_at": datetime.now(timezone.utc).isoformat(),
        "source_report": report,
        "source_report_generated_at": given.get("generated_at"),
        "approved_count": len(out),
        "dry_run": dry_run,
        "datasets": out,
    }


def latest(names: DataFrame, name: str, prefix: str, suffix: str) -> str | None:
    """The largest name with a prefix and a suffix."""
    some = names.filter(F.startswith(name, F.lit(prefix)) & F.endswith(name, F.lit(suffix)))
    return some.agg(F.max(name)).first()[0]


def latest_checkpoint(names: DataFrame, name: str, prefix: str = "checkpoint-") -> str | None:
    """The name with the largest number behind the prefix; others do not count."""
    number = F.regexp_extract(name, f"^{re.escape(prefix)}([0-9]+)$", 1).try_cast("bigint")
    row = names.filter(number.isNotNull()).agg(F.max_by(name, number)).first()
    return row[0]


def checkpoint_statistics(names: DataFrame, name: str, prefix: str = "checkpoint-") -> DataFrame:
    """One row: how many checkpoints, and their names in order."""
    some = names.filter(F.startswith(name, F.lit(prefix)))
    return some.agg(F.count(F.lit(1)).alias("checkpoints"), F.array_sort(F.collect_list(name)).alias("names"))


def quoted(part: str) -> str:
    """A part of an address; slashes stay."""
    return urllib.parse.quote(part, safe="/")


def search_url(base: str, query: str, most: int, phrase: bool = True) -> str:
    """A paper search, newest first: the phrase, or the conjunction of its terms."""
    if phrase:
        asked = f'all:"{query}"'
    else:
        terms = list(dict.fromkeys(w for w in re.split(r"[^A-Za-z0-9]+", query.lower()) if len(w) >= 3))
        asked = " AND ".join(f"all:{w}" for w in terms[:5])
    return f"{base}?search_query={urllib.parse.quote(asked)}&start=0&max_results={most}&sortBy=submittedDate&sortOrder=descending"
