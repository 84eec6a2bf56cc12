"""Campaign metadata snapshot (A3): the campaign service's JSON array, landed as a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.schemas import CAMPAIGN_SNAPSHOT_SCHEMA


def land_campaign_snapshot(dim: DataFrame, path: str) -> None:
    """Write campaigns as the service sends them: JSON arrays with ISO dates, one campaign a file."""
    (dim.select(F.to_json(F.array(F.struct(*[f.name for f in CAMPAIGN_SNAPSHOT_SCHEMA.fields]))).alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def read_campaign_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Read one or more landed snapshots (each file one JSON array) with the declared schema."""
    return spark.read.schema(CAMPAIGN_SNAPSHOT_SCHEMA).option("multiLine", True).json(path)
