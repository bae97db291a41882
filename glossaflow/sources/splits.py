"""Reading datasets made of splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glossaflow.scratch import stage


def read_splits(
    spark: SparkSession,
    files: Mapping[str, Sequence[str]],
    file_format: str = "json",
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read the files of each split into one DataFrame with a ``split`` column.

    Any format and path Spark reads will do. A column that only some splits have is null in the others.
    """
    present = {split: list(paths) for split, paths in files.items() if paths}
    if not present:
        raise ValueError("one of the splits must have a path")
    parts = []
    for split, paths in present.items():
        reader = spark.read.format(file_format).options(**(options or {}))
        if schema is not None:
            reader = reader.schema(schema)
        parts.append(reader.load(paths).withColumn("split", F.lit(split)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_named(spark: SparkSession, name: str, split_column: str = "split") -> DataFrame:
    """Read a catalog table that carries its splits in a column."""
    table = spark.table(name)
    return table if split_column == "split" else table.withColumnRenamed(split_column, "split")


def assign_row_ids(df: DataFrame) -> DataFrame:
    """Add ``row_id`` where the data has no natural key.

    The ids are written once, so every later use of the result sees the same ones.
    """
    return stage(df.withColumn("row_id", F.monotonically_increasing_id()), "rows")


def keep_translate_columns(
    df: DataFrame, keys: Sequence[str], carried: Sequence[str] = ("row_id", "split", "source")
) -> DataFrame:
    """Only the columns to translate, plus the identifying ones the data has."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*[c for c in carried if c in df.columns], *keys)


def select_splits(df: DataFrame, splits: Sequence[str]) -> DataFrame:
    return df.where(F.col("split").isin(list(splits)))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))


def split_preview(df: DataFrame) -> DataFrame:
    """The first row of each split by ``row_id``.

    The smallest ids are found over two narrow columns; one row per split is then broadcast to pick the
    wide rows, so no text is sorted or shuffled.
    """
    first = df.groupBy("split").agg(F.min("row_id").alias("row_id"))
    return df.join(F.broadcast(first), ["split", "row_id"]).select(*df.columns)
