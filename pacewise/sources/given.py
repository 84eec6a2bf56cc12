"""Reading the given tables (``<sf_dir>/<name>.parquet``) and the fixture layers derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacewise.operators.silver import deduplicated, fact_event
from pacewise.session import ensure_utc
from pacewise.sources.fixtures import bronze_from_events, dim_from_nation


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by name (A5)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return bronze_from_events(table(spark, sf_dir, "events"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_event(bronze(spark, sf_dir))


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(bronze(spark, sf_dir))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return dim_from_nation(table(spark, sf_dir, "nation"))
