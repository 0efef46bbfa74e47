"""Run a stream to its present end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.session import scratch_path


def table_stream(spark: SparkSession, folder: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """The parquet files of one table as a stream; the schema is read from the files."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if _is_file(spark, path):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isFile()


def write_append(stream: DataFrame, label: str = "stream") -> str:
    """Run an append stream over all there is, into a folder of parquet files."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def run_append(stream: DataFrame, label: str = "stream") -> DataFrame:
    """The whole result of an append stream over all there is."""
    return stream.sparkSession.read.schema(stream.schema).parquet(write_append(stream, label))


def run_update(stream: DataFrame, key: str, label: str = "stream") -> DataFrame:
    """Run an update stream over all there is; the latest version of each key is its result.

    Each batch writes the rows it changed below its own number, so a batch that is run again after
    a failure writes the same folder again.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, label)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    versions = spark.read.parquet(path)
    names = [name for name in versions.columns if name not in (key, "batch")]
    latest = F.max_by(F.struct(*names), "batch").alias("_latest")
    return versions.groupBy(key).agg(latest).select(key, *[F.col(f"_latest.{name}").alias(name) for name in names])
