"""Maps the star-schema test tables to listening events.

Every rule looks at one row only, so the mapping works on a stream as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide.operators.clean import enrich_events

# Sample user agents and locations.
CHROME_AGENT = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0"
FIREFOX_AGENT = "Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0"
OTHER_AGENT = "curl/8.4.0"
REGISTRATION_START_MS = 1_672_531_200_000
DAY_MS = 86_400_000


EVENT_COLUMNS = (
    # Whole milliseconds since 1970 of a zone-less timestamp, whatever the session zone.
    "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) AS ts",
    "CAST(user_id AS STRING) AS userId",
    "user_id * 100 + CAST(floor((dayofmonth(ts) - 1) / 3) AS BIGINT) AS sessionId",
    """CASE event_type
      WHEN 'view' THEN 'NextSong'
      WHEN 'click' THEN IF(k % 2 = 0, 'Thumbs Up', 'Add to Playlist')
      WHEN 'error' THEN CASE k % 3 WHEN 0 THEN 'Error' WHEN 1 THEN 'Help' ELSE 'Thumbs Down' END
      WHEN 'signup' THEN IF(k % 2 = 0, 'Home', 'Settings')
      WHEN 'purchase' THEN IF(k % 20 = 0, 'Downgrade', 'Upgrade')
    END AS page""",
    "IF(event_id % 3 = 0, 'paid', 'free') AS level",
    "event_id AS itemInSession",
    """CASE user_id % 5
      WHEN 0 THEN 'New York, NY' WHEN 1 THEN 'Chicago, IL' WHEN 2 THEN 'Guam' WHEN 4 THEN 'Austin, TX'
    END AS location""",
    f"""CASE user_id % 4
      WHEN 0 THEN '{CHROME_AGENT}' WHEN 1 THEN '{FIREFOX_AGENT}' WHEN 2 THEN '{OTHER_AGENT}'
    END AS userAgent""",
    f"{REGISTRATION_START_MS} + user_id * {DAY_MS} AS registration",
    "IF(user_id % 2 = 0, 'M', 'F') AS gender",
    "IF(event_type = 'view', concat('artist_', k % 8), NULL) AS artist",
    "IF(event_type = 'view', concat('song_', k % 40), NULL) AS song",
    "IF(event_type = 'view', value, NULL) AS duration",
)


def listening_events(events: DataFrame) -> DataFrame:
    """Raw events of the streaming service from the ``events`` table."""
    return events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k").selectExpr(*EVENT_COLUMNS)


def read_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listening_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def read_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the silver columns. The table has one row per event key already."""
    return enrich_events(read_raw_events(spark, sf_dir))


def stream_raw_events(spark: SparkSession, sf_dir: str, files_per_trigger: int = 64) -> DataFrame:
    """The ``events`` table as a file stream; the pattern lets it be a file or a folder."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{sf_dir}/events[.]parquet")
    )
    return listening_events(stream)


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as plays: customer = user, part = song, brand = artist."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit("NextSong").alias("page"),
            F.col("o_custkey").cast("string").alias("userId"),
            F.col("l_partkey").cast("string").alias("song"),
            F.col("p_brand").alias("artist"),
        )
    )
