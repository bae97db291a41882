"""Writing translated datasets."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glossaflow.functions.text import pair_label, path_slug, run_date_label
from glossaflow.registry.languages import small_table
from glossaflow.scratch import file_system

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
LAYOUT = ("dataset", "pair", "checkpoint", "template", "run_date", "split")
EXTENSIONS = {"csv": "csv", "json": "jsonl"}


@dataclass(frozen=True)
class RunLabels:
    """What names a run in output paths. The run date is given, so that a run can be repeated."""

    dataset: str
    template: str
    checkpoint: str
    run_date: date

    def columns(self) -> dict[str, Column]:
        return {
            "dataset": F.lit(self.dataset),
            "pair": pair_label(F.col("source"), F.col("target")),
            "checkpoint": path_slug(F.lit(self.checkpoint)),
            "template": F.lit(self.template),
            "run_date": run_date_label(F.lit(self.run_date)),
        }


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    return spark.read.schema(schema).options(multiLine="true", **CSV_OPTIONS).csv(path)


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def split_path(root: str, extension: str | Column) -> Column:
    """``<root>/<dataset>/<pair>/<checkpoint>/<template>/<date>/<split>.<extension>`` of a labelled row."""
    extension = F.lit(extension) if isinstance(extension, str) else extension
    return F.concat(F.concat_ws("/", F.lit(root), *LAYOUT), F.lit("."), extension)


def label(df: DataFrame, labels: RunLabels) -> DataFrame:
    return df.withColumns(labels.columns())


def write_canonical(df: DataFrame, path: str) -> None:
    """The table of record: Parquet partitioned by the layout columns. Only leaves in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(path)


def export_splits(
    table: DataFrame, root: str, keys: Sequence[str], formats: Sequence[str] = ("csv", "json")
) -> list[str]:
    """Write one folder ``<split>.<extension>`` per pair and split of a labelled table; returns their paths.

    A format is one job, whatever the number of pairs: one partitioned write beside the target folders, whose finished
    leaves are then moved into place. So a repeated run replaces exactly its leaves, and a job that fails leaves all
    of them as they were. Moves are file system operations of the driver, one per leaf; :func:`commit_leaves` goes
    on with them if the driver was lost meanwhile.
    """
    root = root.rstrip("/")
    done = []
    for file_format in formats:
        staging = f"{root}/_writing-{uuid.uuid4().hex}"
        (write_csv if file_format == "csv" else write_jsonl)(table.select(*LAYOUT, *keys), staging, LAYOUT)
        done += commit_leaves(table.sparkSession, root, staging, EXTENSIONS[file_format])
    return sorted(done)


def written_leaves(spark: SparkSession, staging: str) -> list[tuple[str, ...]]:
    """``(folder, *values of the layout)`` of every leaf of a partitioned write: the manifest of what it made."""
    system, top = file_system(spark, staging)
    leaves = [(top, ())]
    for column in LAYOUT:
        steps = [(status.getPath(), values) for folder, values in leaves for status in system.listStatus(folder)]
        steps = [(path, values) for path, values in steps if path.getName().startswith(f"{column}=")]
        leaves = [(path, (*values, unquote(path.getName().split("=", 1)[1]))) for path, values in steps]
    return [(path.toString(), *values) for path, values in leaves]


def commit_leaves(spark: SparkSession, root: str, staging: str, extension: str) -> list[str]:
    """Move the leaves below ``staging`` to their places below ``root``, replacing what is there; then drop ``staging``.

    A leaf that has been moved is no longer below ``staging``, so this can be repeated until it has gone through.
    """
    leaves = written_leaves(spark, staging)
    if not leaves:
        file_system(spark, staging)[0].delete(file_system(spark, staging)[1], True)
        return []
    listed = small_table(spark, {name: list(v) for name, v in zip(("folder", *LAYOUT), zip(*leaves))})
    moves = listed.select("folder", split_path(root, extension).alias("path")).collect()

    def move(row) -> str:
        system, source = file_system(spark, row["folder"])
        _, target = file_system(spark, row["path"])
        system.mkdirs(target.getParent())
        system.delete(target, True)
        if not system.rename(source, target):
            raise OSError(f"could not move {row['folder']} to {row['path']}")
        return row["path"]

    with ThreadPoolExecutor(8) as pool:
        paths = list(pool.map(move, moves))
    system, top = file_system(spark, staging)
    system.delete(top, True)
    return paths


def written_rows(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """``(path, n_rows)`` of exported folders, counted by reading their files."""
    parts = []
    for extension in EXTENSIONS.values():
        mine = [p for p in paths if p.endswith(f".{extension}")]
        if mine:
            read = read_csv if extension == "csv" else read_jsonl
            rows = read(spark, mine, schema)
            folder = F.regexp_replace(rows.metadataColumn("_metadata")["file_path"], "/[^/]*$", "")
            parts.append(rows.select(folder.alias("path")).groupBy("path").agg(F.count("*").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)
