"""Reading and writing the bronze, silver and gold layers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NOT_THERE_YET = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_layer(
    spark: SparkSession, path: str, recursive: bool = False, skip_corrupt: bool = False
) -> DataFrame | None:
    """A Parquet layer, or None when nothing was written yet.

    Only a missing or empty path gives None; any other error is raised.
    ``recursive`` ignores partition folders and so loses the partition column;
    ``skip_corrupt`` leaves out unreadable files.
    """
    reader = spark.read.option("mergeSchema", "false")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NOT_THERE_YET:
            raise
    if not skip_corrupt:
        return None
    # The schema comes from one file, which may be a corrupt one: look at all footers.
    try:
        return reader.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NOT_THERE_YET:
            raise
        return None


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the files of a layer that ``skip_corrupt`` leaves out.

    Files that give a row are found by reading the layer's rows; only the few others are
    opened, and those that are whole Parquet files without rows are no loss. A missing
    layer has no such files. Hidden files (``_`` or ``.`` first) belong to no layer.
    """
    found = read_layer(spark, path, recursive=True, skip_corrupt=True)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() not in NOT_THERE_YET:
            raise
        return spark.createDataFrame([], "path string, length long")
    name = F.regexp_extract("path", "[^/]+$", 0)
    files = files.filter(~name.rlike("^[_.]"))
    if found is not None:
        read = found.select(F.col("_metadata.file_path").alias("_read")).distinct()
        plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  (one slash or three)
        files = files.join(read, plain("path") == plain("_read"), "left_anti")

    def broken(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, content in enumerate(batch["content"]):
                try:
                    pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                except pa.ArrowInvalid:
                    yield batch.select(["path", "length"]).slice(row, 1)

    return files.select("path", "length", "content").mapInArrow(broken, "path string, length long")


def append_layer(df: DataFrame, path: str, by: str | None = "page", rebalance: bool = False) -> None:
    """Append, partitioned by ``by``.

    ``rebalance`` gathers each folder's rows into files of the advisory size,
    splitting large folders over many tasks, instead of one small file per task
    and folder.
    """
    if by is None:
        df.write.mode("append").parquet(path)
        return
    rows = df.hint("rebalance", F.col(by)) if rebalance else df
    rows.write.mode("append").partitionBy(by).parquet(path)


def replace_layer(df: DataFrame, path: str) -> None:
    """Overwrite a gold table."""
    df.write.mode("overwrite").parquet(path)


VERSIONS = "version long, folder string"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Versions of a published table, the newest first."""
    rows = read_layer(spark, f"{path}/versions")
    return [] if rows is None else sorted(((r["version"], r["folder"]) for r in rows.collect()), reverse=True)


def publish_layer(df: DataFrame, path: str) -> int:
    """The next version of a gold table, seen by readers whole or not at all.

    The rows go to a folder of their own; then one small file names it, and appears in
    one step when it is committed. A reader that has resolved an older version keeps
    reading it, as no file of it is touched. A job that dies before the naming file
    leaves a folder that nobody reads. Returns the version; expire old folders by age.
    One writer at a time: of two that take the same number, the greater folder name wins.
    """
    spark = df.sparkSession
    version = (_versions(spark, path) or [(0, "")])[0][0] + 1
    folder = f"rows/{version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    spark.createDataFrame([(version, folder)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The newest version of a published table, or the given one; None if there is none."""
    found = [folder for number, folder in _versions(spark, path) if version in (None, number)]
    return spark.read.parquet(f"{path}/{found[0]}") if found else None


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON copy of a mapping or a summary."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(by) if by else writer).json(path)


def compact_layer(spark: SparkSession, source: str, target: str, by: str = "page") -> None:
    """Rewrite a layer of many small files into another folder."""
    append_layer(spark.read.parquet(source), target, by, rebalance=True)


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Path, time and size of each Parquet file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )


def layer_stats(spark: SparkSession, layers: dict[str, str], events_per_file: int = 2000) -> DataFrame:
    """Files, size and age of each layer, with an estimate of events per minute."""
    parts = []
    for layer, path in layers.items():
        try:
            listed = file_listing(spark, path)
        except AnalysisException as error:
            if error.getCondition() not in NOT_THERE_YET:
                raise
            listed = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
        parts.append(
            listed.agg(
                F.count(F.lit(1)).alias("files"),
                F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 2).alias("size_mb"),
                F.min("modificationTime").alias("oldest"),
                F.max("modificationTime").alias("newest"),
            ).select(F.lit(layer).alias("layer"), "*")
        )
    stats = parts[0]
    for part in parts[1:]:
        stats = stats.unionByName(part)
    minutes = F.greatest(F.lit(1.0), (F.unix_micros("newest") - F.unix_micros("oldest")) / 60e6)
    return stats.withColumns(
        {
            "events_per_min": F.when(F.col("files") > 0, F.round(F.col("files") * events_per_file / minutes)),
            "status": F.when(F.col("files") > 0, "READY").otherwise("EMPTY"),
        }
    )


def layer_lag(stats: DataFrame, first: str = "bronze", second: str = "silver") -> DataFrame:
    """Minutes between the newest files of two layers."""

    def newest(layer: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.unix_micros("newest")))

    return stats.agg(F.round(F.abs(newest(second) - newest(first)) / 60e6, 1).alias("lag_min"))


def output_status(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """Which outputs exist, as (name, status)."""
    rows = [
        (name, "READY" if read_layer(spark, path) is not None else "PENDING") for name, path in outputs.items()
    ]
    return spark.createDataFrame(rows, "name string, status string")


def load_or_create_baseline(spark: SparkSession, path: str, current: DataFrame) -> DataFrame:
    """Stored baseline; the first run stores ``current`` as such."""
    stored = read_layer(spark, path)
    if stored is None:
        replace_layer(current, path)
        stored = spark.read.parquet(path)
    return stored


def save_model(model, path: str) -> None:
    """S14."""
    model.write().overwrite().save(path)


def load_model(kind, path: str):
    """``kind`` is the model class, such as ``PipelineModel`` or ``ALSModel``."""
    return kind.load(path)
