"""Raw files to rows of (source_file, source_record_index, record), record a map of variants.

Indices restart in each file and follow the file's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import strip

RECORD = "map<string,variant>"
SUPPORTED = (".jsonl", ".json", ".csv", ".parquet")


class UnsupportedFormat(ValueError):
    """A file whose suffix no reader takes."""


def _numbered(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Number a file's rows from 0: by block of the file, then by place in it, with blocks' offsets added."""
    df = df.withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"), "__at": F.monotonically_increasing_id()})
    sizes = df.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__file", "__block").orderBy("__at")
    df = df.withColumn("__row", F.row_number().over(inside) - 1).join(offsets, ["__file", "__block"])
    return df.select(F.col("__file").alias("source_file"), (F.col("__first") + F.col("__row")).alias("source_record_index"), *columns)


def read_jsonl(spark: SparkSession, *paths: str) -> DataFrame:
    """An object per line that is not blank; a malformed line is an error, other values have a null record."""
    lines = spark.read.text(list(paths)).filter(F.trim("value") != "")
    parsed = F.parse_json("value")
    record = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.from_json("value", RECORD))
    return _numbered(lines, record.alias("record"))


def read_json(spark: SparkSession, *paths: str) -> DataFrame:
    """A list is rows, ``{"data": [...]}`` the rows of data, anything else one row."""
    whole = spark.read.text(list(paths), wholetext=True)
    whole = whole.select(F.col("_metadata.file_path").alias("source_file"), F.parse_json("value").alias("v"))
    v = F.col("v")
    is_list = lambda x: F.coalesce(F.schema_of_variant(x).startswith("ARRAY"), F.lit(False))
    data = F.when(F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$.data", "variant"))
    items = F.when(is_list(v), F.variant_get(v, "$", "array<variant>")).when(is_list(data), F.variant_get(data, "$", "array<variant>")).otherwise(F.array(v))
    rows = whole.select("source_file", F.posexplode(items).alias("source_record_index", "x"))
    record = F.when(F.schema_of_variant("x").startswith("OBJECT"), F.from_json(F.to_json("x"), RECORD))
    return rows.select("source_file", F.col("source_record_index").cast("bigint").alias("source_record_index"), record.alias("record"))


def _as_record(columns: list[str]) -> Column:
    return F.from_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), RECORD)


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Header row, all strings, quoted line ends."""
    df = spark.read.csv(list(paths), header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return _numbered(df, _as_record(df.columns).alias("record"))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Nulls stay nulls, list columns are lists."""
    df = spark.read.parquet(*paths)
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_record_index"), _as_record(df.columns).alias("record"))


READERS = {".jsonl": read_jsonl, ".json": read_json, ".csv": read_csv, ".parquet": read_parquet}


def suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of any supported format, dispatched by suffix in any case."""
    by: dict[str, list[str]] = {}
    for p in paths:
        if suffix(p) not in READERS:
            raise UnsupportedFormat(f"unsupported format: {p}")
        by.setdefault(suffix(p), []).append(p)
    out = None
    for kind, some in by.items():
        df = READERS[kind](spark, *some)
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no files")
    return out


def manifest_files(spark: SparkSession, manifest: str, dataset_ids: list[str] | None = None) -> DataFrame:
    """Rows (dataset_id, license, path, supported) of a raw manifest; none of the wanted ids found is an error."""
    schema = "datasets array<struct<id:string,license:string,local_dir:string,files:array<struct<path:string>>>>"
    m = spark.read.schema(schema).json(manifest, multiLine=True).select(F.explode("datasets").alias("d"))
    if dataset_ids:
        wanted = spark.createDataFrame([(i,) for i in dataset_ids], "id string")
        m = m.join(F.broadcast(wanted), F.col("d.id") == wanted["id"], "left_semi")
        if m.isEmpty():
            raise ValueError(f"no dataset of {dataset_ids} in the manifest")
    files = m.select(F.col("d.id").alias("dataset_id"), F.col("d.license").alias("license"), F.explode_outer("d.files.path").alias("path"))
    ends = F.concat(F.lit("."), F.lower(F.element_at(F.split("path", r"\."), -1)))
    return files.withColumn("supported", F.coalesce(ends.isin(list(READERS)), F.lit(False)))


def read_manifest(spark: SparkSession, manifest: str, dataset_ids: list[str] | None = None) -> DataFrame:
    """All supported files of a manifest's datasets; a dataset with none is an error."""
    rows = manifest_files(spark, manifest, dataset_ids).collect()  # a row per file: metadata
    out = None
    for dataset in dict.fromkeys(r["dataset_id"] for r in rows):
        own = [r for r in rows if r["dataset_id"] == dataset]
        paths = [r["path"] for r in own if r["supported"]]
        if not paths:
            raise RuntimeError(f"{dataset} has no supported data files")
        df = read_files(spark, paths).withColumns({"dataset_id": F.lit(dataset), "source_license": F.lit(own[0]["license"])})
        out = df if out is None else out.unionByName(df)
    return out


def manifest_report(files: DataFrame) -> DataFrame:
    """Files of a manifest by dataset: how many are read and how many have a format that no reader takes."""
    return files.groupBy("dataset_id").agg(
        F.count_if("supported").alias("processed_files"),
        F.count_if(~F.col("supported") & F.col("path").isNotNull()).alias("skipped_files"),
        F.array_sort(F.collect_list(F.when(~F.col("supported"), F.col("path")))).alias("skipped"),
    )


def read_optional(spark: SparkSession, directory: str, source_type: str) -> DataFrame:
    """All ``*.jsonl`` below a directory, a missing one is empty; rows without conversations are an error."""
    schema = "record_id string, source_type string, dataset_id string, conversations array<struct<role:string,content:string>>, text string"
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).json(directory, recursiveFileLookup=True, pathGlobFilter="*.jsonl")
    missing = F.raise_error(F.concat(F.lit("no conversations in "), F.col("_metadata.file_path")))
    return df.withColumns(
        {
            "conversations": F.when(F.col("conversations").isNotNull(), F.col("conversations")).otherwise(missing.cast(df.schema["conversations"].dataType)),
            "record_id": F.coalesce("record_id", F.sha2(F.to_json("conversations"), 256)),
            "source_type": F.coalesce("source_type", F.lit(source_type)),
            "dataset_id": F.coalesce("dataset_id", F.lit(source_type)),
        }
    )


def read_passing(spark: SparkSession, path: str) -> DataFrame:
    """Scored records that pass the filter; it reaches the Parquet scan."""
    return spark.read.parquet(path).filter("passes_training_filter")


def read_atom(spark: SparkSession, path: str, since: int = 2023, pdf: str = "https://arxiv.org/pdf/", abstract: str = "https://arxiv.org/abs/") -> DataFrame:
    """Entries of an Atom feed published in ``since`` or later, before 2100: eight fields."""
    schema = "id string, title string, summary string, published string, author array<struct<name:string>>"
    df = spark.read.schema(schema).format("xml").option("rowTag", "entry").option("ignoreSurroundingSpaces", "false").load(path)
    year = F.substring("published", 1, 4).try_cast("int")
    short = F.element_at(F.split(F.coalesce("id", F.lit("")), "/"), -1)
    text = lambda c: F.coalesce(strip(F.col(c)), F.lit(""))
    return df.filter((year >= since) & (year < 2100)).select(
        F.coalesce("id", F.lit("")).alias("id"),
        short.alias("arxiv_id"),
        text("title").alias("title"),
        "published",
        F.transform(F.coalesce("author", F.array().cast("array<struct<name:string>>")), lambda x: F.coalesce(strip(x["name"]), F.lit(""))).alias("authors"),
        text("summary").alias("summary"),
        F.concat(F.lit(pdf), short, F.lit(".pdf")).alias("pdf_url"),
        F.concat(F.lit(abstract), short).alias("abs_url"),
    )
