"""Rewriting chosen files of a table, as a Spark job: each target file is written by one task from the
rows of its source files, and nothing but those files is read or replaced."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pacewise.sources import fs
from pacewise.sources.tables import Table

STAGES = ("__erase_", "__compact_", "__merge_")  # siblings of a table that hold files not yet in it


def stage_path(table_path: str, kind: str) -> str:
    return f"{table_path.rstrip('/')}__{kind}_{uuid.uuid4().hex[:10]}"


def file_name() -> Column:
    return F.col("_metadata.file_path")


def _content(columns: list[str]) -> tuple[Column, Column]:
    """Row count and the sum of the rows' 64-bit hashes, free of their order."""
    return F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).alias("h")


def stage_files(table: Table, rows: DataFrame, path: str, sort: bool = True) -> tuple[int, int]:
    """Writes ``rows`` (the table's columns and ``target``, a string) as one file for each target, in
    ``path/target=<target>/``; the row count and content hash that the writing tasks saw.

    All rows of a target come from files that together are about one file's size, so one task can
    write them.
    """
    stored = [f.name for f in table.read_schema.fields if f.name not in table.partition_by]
    rows = rows.repartition("target").sortWithinPartitions("target", *(table.cluster_by if sort else ()))
    seen = Observation()
    (rows.select("target", *stored).observe(seen, *_content(stored))
     .write.options(**table.file_options).option("maxRecordsPerFile", "0").partitionBy("target").parquet(path))
    return int(seen.get["n"]), int(seen.get["h"])


def staged_files(spark: SparkSession, path: str) -> dict[str, str]:
    """target -> its staged file."""
    if not fs.has_data_files(spark, path):
        return {}
    files = [fs.plain(f) for f in spark.read.schema("target string").option("recursiveFileLookup", "true").parquet(path).inputFiles()]
    found = {f.rsplit("/", 2)[1].split("=", 1)[1]: f for f in files}
    if len(found) < len(files):
        raise AssertionError(f"{path} has several files for one target")
    return found


def check_stage(spark: SparkSession, table: Table, path: str, want: tuple[int, int]) -> None:
    """Reads the staged files back: they must hold what the writing tasks saw."""
    stored = [f for f in table.read_schema.fields if f.name not in table.partition_by]
    rows = spark.read.schema(StructType(stored)).option("recursiveFileLookup", "true").parquet(path)
    got = rows.agg(*_content([f.name for f in stored])).first()
    if (int(got["n"]), int(got["h"])) != want:
        raise AssertionError(f"{path}: read back {tuple(got)}, wrote {want}; the table is as it was")
