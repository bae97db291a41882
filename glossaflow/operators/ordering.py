"""Running totals and batches over a whole split without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.scratch import stage


def running_total(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the same group, in ``order``.

    Give it narrow rows: they are written once, as finding the chunk borders reads them a second time. They
    are range-partitioned on (group, order), so a group of any size is cut into even chunks. The
    chunks are written as well, which fixes their borders; a chunk's start is the total of the chunks before
    it (one row per chunk), and inside a chunk an ordinary window runs.
    """
    keys = [*groups, *order]
    rows = stage(df, "rows")
    chunked = stage(rows.repartitionByRange(*keys).withColumn("__chunk", F.spark_partition_id()), "chunks")
    before = Window.partitionBy(*groups).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunked.groupBy(*groups, "__chunk")
        .agg(F.sum(value).alias("__total"))
        .withColumn("__start", F.coalesce(F.sum("__total").over(before), F.lit(0)))
        .drop("__total")
    )
    inside = Window.partitionBy(*groups, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, [*groups, "__chunk"])
        .withColumn(out, F.col("__start") + F.col("__inside"))
        .drop("__chunk", "__start", "__inside")
    )


def sentence_offsets(df: DataFrame, groups: Sequence[str], order: Sequence[str], count: str) -> DataFrame:
    """Start and end position of each row's sentences in the flat sentence list of its split."""
    return running_total(df, groups, order, count, "start_pos").withColumn(
        "end_pos", F.col("start_pos") + F.col(count)
    )


def batch_numbers(df: DataFrame, groups: Sequence[str], order: Sequence[str], batch_rows: int = 40) -> DataFrame:
    """Number consecutive batches of ``batch_rows`` rows within each group."""
    ranked = running_total(df.withColumn("__one", F.lit(1)), groups, order, "__one", "__rank").drop("__one")
    return ranked.withColumn("batch_id", F.floor(F.col("__rank") / batch_rows).cast("long")).drop("__rank")


def batch_plan(
    df: DataFrame,
    text: str,
    groups: Sequence[str],
    order: Sequence[str],
    batch_rows: int = 40,
    byte_limit: int = 204_800,
) -> DataFrame:
    """Rows and bytes of every batch, and whether it breaks the byte limit of one call."""
    sized = df.select(*groups, *order, F.octet_length(text).cast("long").alias("__bytes"))
    return (
        batch_numbers(sized, groups, order, batch_rows)
        .groupBy(*groups, "batch_id")
        .agg(F.count("*").alias("n_rows"), F.sum("__bytes").alias("n_bytes"))
        .withColumn("over_limit", F.col("n_bytes") > byte_limit)
    )
