"""Building blocks that keep hot keys and global orders out of a single task."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if configured:
        if configured.startswith("file:") and not local:
            raise ValueError("spark.checkpoint.dir must not be a folder of one machine")
        return configured
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="playtide-")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back.

    The rows survive the loss of any executor, later readers neither repeat the
    work nor see a random choice made twice, and they read only the columns
    they need.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Zero-based rank of every row in the global order, without a one-task window.

    A range-partitioned sort numbers rows inside each partition; the partition
    sizes, one row per partition, give the offset to add. The sorted rows are
    stored first, so both reads see the same partitions.
    """
    placed = cut_lineage(
        df.sort(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_part", "_local", "_offset")
    )


def stored_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` sorted and stored, with the number of the range each row fell into as ``_part``."""
    return cut_lineage(df.sort(*order).withColumn("_part", F.spark_partition_id()))


def running_totals(ranges: DataFrame, group: str, order: str, values: Sequence[str]) -> DataFrame:
    """Cumulative sums of ``values`` by ``order`` inside each ``group`` of ``stored_ranges``.

    A group may be as large as the table: it is summed range by range, and each
    range starts from the total of the ones before it.
    """
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranges.groupBy(group, "_part")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(group, "_part", *[F.sum(v).over(before).alias(f"_start_{v}") for v in values])
        .filter(F.col(f"_start_{values[0]}").isNotNull())
    )
    inside = W.partitionBy(group, "_part").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    running = ranges.select(
        group, "_part", order, *[F.sum(v).over(inside).alias(f"_run_{v}") for v in values]
    )
    # Only the first group of a range goes on from an earlier one: a row per range at most.
    total = {v: F.col(f"_run_{v}") + F.coalesce(f"_start_{v}", F.lit(0)) for v in values}
    return running.join(F.broadcast(starts), [group, "_part"], "left").select(
        group, order, *[c.alias(f"running_{v}") for v, c in total.items()]
    )


def carried(ranges: DataFrame, group: str, order: str, value: Column) -> tuple[Column, DataFrame]:
    """The greatest ``value`` so far in each ``group`` of ``stored_ranges``, ties of ``order`` included.

    Gives a window column for the rows of a range, and a table (group, _part,
    ``_carry``) of what the first group of a range has from earlier ones: a row
    per range at most.
    """
    inside = W.partitionBy("_part", group).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ends = ranges.groupBy(group, "_part").agg(F.max(value).alias("_end"))
    carry = ends.select(group, "_part", F.max("_end").over(before).alias("_carry")).filter(F.col("_carry").isNotNull())
    return F.max(value).over(inside), carry


def exact_percentile(df: DataFrame, col: str, fraction: float) -> float | None:
    """Percentile with linear interpolation.

    The built-in ``percentile`` keeps every distinct value of the column in one
    buffer. Here equal values are counted first, on the map side too, so a value
    that fills the table is one row; running totals over the sorted counts then
    show the two values around the wanted rank.
    """
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ranges = stored_ranges(counted.withColumn("_all", F.lit(0)), col)
    count = ranges.agg(F.sum("n")).first()[0]
    if count is None:
        return None
    rank = fraction * (count - 1)
    low, high = math.floor(rank), math.ceil(rank)
    running = running_totals(ranges, "_all", col, ["n"])
    found = running.agg(*[F.min(F.when(F.col("running_n") > r, F.col(col))) for r in (low, high)]).first()
    return float(found[0] + (rank - low) * (found[1] - found[0]))


KLL_K = 800  # rank error below half a percent


def daily_sketches(df: DataFrame, time: str, col: str, k: int = KLL_K) -> DataFrame:
    """(day, sketch) of a numeric column; a few KB a day, whatever the rows, nulls left out."""
    known = df.filter(F.col(col).isNotNull())
    return known.groupBy(F.to_date(time).alias("day")).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("sketch"))


def merged_percentile(sketches: DataFrame, fraction: float, *by: str) -> DataFrame:
    """(rows, percentile) of all sketches, or of those of each ``by``; no event is read again."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_merged")).filter(F.kll_sketch_get_n_double("_merged") > 0)
    found = F.kll_sketch_get_quantile_double("_merged", F.lit(fraction))
    return merged.select(*by, F.kll_sketch_get_n_double("_merged").alias("rows"), found.alias("percentile"))
