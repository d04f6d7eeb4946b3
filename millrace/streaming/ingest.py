"""Files that arrive, taken in bounded batches with a checkpoint; each run goes on where the last one ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def stream_files(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 16, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | str, files_per_batch: int = 16) -> DataFrame:
    """The files of table ``name``, which is one file in ``sf_dir`` or a folder of files (a stream's source must be a folder)."""
    path = f"{sf_dir}/{name}.parquet"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return stream_files(spark, path, schema, files_per_batch)
    return stream_files(spark, sf_dir, schema, files_per_batch, glob=f"{name}.parquet")


def run_available(stream: DataFrame, table_path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there in batches, write Parquet, stop."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", table_path)
    query.outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def ingest_events(spark: SparkSession, source: str, schema, table_path: str, checkpoint: str, glob: str | None = None) -> DataFrame:
    """Append-only event ingestion; returns the table."""
    run_available(stream_files(spark, source, schema, glob=glob), table_path, checkpoint)
    return spark.read.parquet(table_path)


def dedup_stream(stream: DataFrame, digest: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """First row of each digest; with a watermark (column, delay) old state is dropped."""
    if watermark:
        return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark([digest])
    return stream.dropDuplicates([digest])


def windowed_counts(stream: DataFrame, ts: str, delay: str = "1 hour", width: str = "1 day", by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Extension: counts by tumbling window. Append mode holds open windows back, ``run_updates`` does not."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), *by, "n")
    )


def run_updates(stream: DataFrame, table_path: str, checkpoint: str) -> None:
    """Process what is there and append every row that changed, with its batch; ``newest`` reads the last state.

    A batch that is written again after a failure has the same number and rows.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(table_path)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.outputMode("update").trigger(availableNow=True).start().awaitTermination()


def newest(spark: SparkSession, table_path: str, keys: list[str]) -> DataFrame:
    """The last state of each key of a table of updates."""
    df = spark.read.parquet(table_path)
    rest = [c for c in df.columns if c not in (*keys, "batch")]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*")
