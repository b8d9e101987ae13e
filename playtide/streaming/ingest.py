"""Stream ingest: payload text to bronze files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from playtide.functions.columns import epoch_ms_to_ts
from playtide.schema import EVENT_SCHEMA


def read_event_stream(spark: SparkSession, source: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Stream with a ``value`` column.

    ``kafka`` reads a topic from its first offset, takes all there is and fails on
    lost offsets; ``maxOffsetsPerTrigger`` and ``failOnDataLoss`` are options.
    ``text`` and other file formats read files that arrive in ``path``.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        options = {"startingOffsets": "earliest", **options}
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def decode_events(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, truncate_seconds: bool = False) -> DataFrame:
    """JSON payload to columns; a field that does not parse is null."""
    flat = df.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")
    if "length" in flat.columns:
        flat = flat.withColumn("duration", F.coalesce("duration", "length")).drop("length")
    return flat.withColumns(
        {
            "ingestion_time": F.current_timestamp(),
            "event_time": epoch_ms_to_ts(F.col("ts"), truncate_seconds),
        }
    )


def parse_events(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, truncate_seconds: bool = False) -> DataFrame:
    """Decoded events that have a time."""
    return decode_events(df, schema, truncate_seconds).filter(F.col("ts").isNotNull())


def rejected_events(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Payloads that ``parse_events`` drops."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return df.filter(parsed["ts"].isNull())


def write_bronze(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Append to Parquet files partitioned by page.

    The file sink's log makes a retried batch write its rows once.
    ``every=None`` takes what is there and stops.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("page")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def ingest(stream: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Payload stream to bronze."""
    return write_bronze(parse_events(stream), path, checkpoint, every)
