"""Partition layouts and what they buy: pruning helpers, the layout study, file-layout report and
scan volume (A8, A9, A16, A17, B9, D8, D13, F4, L13-L15)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.constants import AMPLIFY, BAD_LAYOUT_FILES, MIN_INPUT_FILES
from pacewise.functions import user_bucket, utc_day
from pacewise.operators.analyst import amplify_blocks, with_copies
from pacewise.sources import fs
from pacewise.sources.tables import Table, flat_table, silver_table


# --- pruning helpers ---------------------------------------------------------------------------
def user_partitions(df: DataFrame, user_id: str, bucket_col: str = "user_bucket") -> Column:
    """The bucket predicate that ``user_id = x`` implies.

    The bucket of a literal constant-folds, so the scan gets a static partition filter
    (``user_bucket = k``) besides the pushed-down ``user_id`` filter.
    """
    return F.col(bucket_col) == user_bucket(F.lit(user_id)) if bucket_col in df.columns else F.lit(True)


def time_partitions(df: DataFrame, start: Column, end: Column, date_col: str = "event_date") -> Column:
    """The day range that the half-open ``[start, end)`` implies."""
    last = end - F.expr("INTERVAL 1 MICROSECOND")
    return F.col(date_col).between(utc_day(start), utc_day(last)) if date_col in df.columns else F.lit(True)


def prune_by_user(df: DataFrame, user_id: str, bucket_col: str = "user_bucket") -> DataFrame:
    """``user_id = x`` plus the bucket predicate it implies."""
    return df.where((F.col("user_id") == F.lit(user_id)) & user_partitions(df, user_id, bucket_col))


def prune_by_time(df: DataFrame, ts_col: str, start: Column, end: Column,
                  date_col: str = "event_date") -> DataFrame:
    """Half-open ``[start, end)`` on ``ts_col`` plus the day-partition range it implies."""
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) < end) & time_partitions(df, start, end, date_col))


# --- the layout query set (L14) -------------------------------------------------------------------
def user_filtered_scan(df: DataFrame, user_id: str) -> DataFrame:
    return prune_by_user(df, user_id).agg(F.count(F.lit(1)).alias("events")) \
        .select(F.lit(user_id).alias("user_id"), "events")


def first_day(df: DataFrame) -> DataFrame:
    """``CAST(min(event_ts) AS DATE)`` (D8); on the day-partitioned layout Spark can answer
    the ``min`` of the partition column from the listing alone."""
    if "event_date" in df.columns:
        return df.agg(F.min("event_date").alias("day"))
    return df.agg(utc_day(F.min("event_ts")).alias("day"))


def two_days(day) -> tuple[Column, Column]:
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    return start, start + F.expr("INTERVAL 2 DAY")


def date_range_scan(df: DataFrame, day) -> DataFrame:
    """Events in the two days starting at ``day``."""
    return prune_by_time(df, "event_ts", *two_days(day)).agg(F.count(F.lit(1)).alias("events")) \
        .select(F.lit(day).cast("date").alias("first_day"), "events")


def campaign_rollup(df: DataFrame) -> DataFrame:
    """Impressions per campaign (D3); reads every file on either layout."""
    return (df.where(F.col("event_type") == "impression")
            .groupBy("campaign_id").agg(F.count(F.lit(1)).alias("impressions")))


# --- file layout report (A17, D13) ---------------------------------------------------------------
def file_stats(spark: SparkSession, table: Table) -> DataFrame:
    """One row per data file: path, size, rows, plus the partition values."""
    scan = table.read(spark, layout=True)
    return (scan.select(*table.partition_by, F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size"))
            .groupBy(*table.partition_by, "file_path", "file_size")
            .agg(F.count(F.lit(1)).alias("rows")))


def layout_report(spark: SparkSession, table: Table, label: str) -> DataFrame:
    """Files, total and average file size, rows. Distributed: files are grouped on the cluster."""
    return (file_stats(spark, table)
            .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("total_bytes"),
                 F.avg("file_size").alias("avg_file_bytes"), F.sum("rows").alias("rows"))
            .select(F.lit(label).alias("layout"), "files", "total_bytes", "avg_file_bytes", "rows"))


# --- scan volume (L15) ---------------------------------------------------------------------------
def opened_files(df: DataFrame, partitions: Column) -> DataFrame:
    """(file_path, file_size) of the files that a scan behind the partition filter opens."""
    return (df.where(partitions).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
            .distinct())


def column_bytes(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file_path, column, bytes): compressed size of each column's chunks, from the files' own footers.

    Spark's binary source hands each file to a task, so any store that Spark reads will do.
    """
    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                meta = pq.read_metadata(pa.BufferReader(content.as_buffer()))
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                sizes = [sum(g.column(c).total_compressed_size for g in groups) for c in range(meta.num_columns)]
                names = [meta.schema.column(c).path.split(".")[0] for c in range(meta.num_columns)]
                yield pa.RecordBatch.from_pydict({"file_path": [path] * len(names), "column": names, "bytes": pa.array(sizes, pa.int64())})

    if not files:
        return spark.createDataFrame([], "file_path string, column string, bytes bigint")
    scan = spark.read.format("binaryFile").load([fs.plain(f) for f in files]).select("path", "content")
    return scan.mapInArrow(footers, "file_path string, column string, bytes bigint")


def scan_volume(spark: SparkSession, table: Table, user_id: str, day) -> DataFrame:
    """For each query of the layout set and for a read of everything: files opened, their full size, and the
    bytes of the columns that the query reads (partition columns are in no file)."""
    df = table.read(spark, layout=True)
    queries = {"user-filtered scan": (user_partitions(df, user_id), ["user_id"]),
               "date-range scan": (time_partitions(df, *two_days(day)), ["event_ts"]),
               "campaign rollup": (F.lit(True), ["event_type", "campaign_id"]),
               "everything": (F.lit(True), [f.name for f in table.contract.fields])}
    sizes = column_bytes(spark, [r["file_path"] for r in opened_files(df, F.lit(True)).collect()])
    sizes = sizes.select(F.substring_index("file_path", table.path.rsplit("/", 1)[-1], -1).alias("file"), "column", "bytes")
    out = None
    for name, (partitions, columns) in queries.items():
        opened = opened_files(df, partitions).select(
            F.substring_index("file_path", table.path.rsplit("/", 1)[-1], -1).alias("file"), "file_size")
        read = sizes.where(F.col("column").isin(columns)).join(opened, "file", "left_semi").agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar()
        row = opened.agg(F.count(F.lit(1)).alias("files_read"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("file_bytes")).select(
            F.lit(name).alias("query"), "files_read", "file_bytes", read.alias("column_bytes"))
        out = row if out is None else out.unionByName(row)
    return out


# --- the layout study (L13) ----------------------------------------------------------------------
@dataclass(frozen=True)
class LayoutStudy:
    source: Table
    bad: Table
    optimized: Table


def build_layout_study(spark: SparkSession, silver: DataFrame, root: str,
                       copies: int = AMPLIFY, bad_files: int = BAD_LAYOUT_FILES) -> LayoutStudy:
    """Store silver once as a shared source table, then write it amplified twice: unpartitioned in
    ``bad_files`` files, and partitioned by day and user bucket, sort-clustered by campaign and
    time and sort-compacted. Both layouts are written from the same source, so they hold the
    same rows (checked). The writing tasks make the copies: shuffles and sorts carry one row of an event,
    and a copy has its event's day, user, campaign and time, so it belongs where the event does."""
    from pacewise.operators.maintenance import compact  # local: maintenance imports this module

    source = flat_table(f"{root}/source", name="source")
    silver.select(*[f.name for f in source.contract.fields]).write.mode("overwrite").parquet(source.path)
    bad = flat_table(f"{root}/events_bad", name="events_bad")
    optimized = silver_table(f"{root}/events_optimized", name="events_optimized")
    src = source.read(spark)
    bad.write_unpartitioned_files(src, bad_files, copied=lambda rows: amplify_blocks(rows, copies))
    optimized.write(src, copied=lambda rows: with_copies(rows, copies))
    compact(spark, optimized, min_input_files=MIN_INPUT_FILES, sort=True)
    want, n_bad, n_opt = copies * src.count(), bad.read(spark).count(), optimized.read(spark).count()
    if n_bad != want or n_opt != want:
        raise AssertionError(f"layouts differ: bad={n_bad} optimized={n_opt}, {want} rows to write")
    return LayoutStudy(source, bad, optimized)
