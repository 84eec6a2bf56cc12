"""Silver layer: the deduplicated event fact (L3) and the campaign dimension (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacewise.operators.maintenance import in_partitions, partition_key
from pacewise.schemas import DIM_CAMPAIGN_SCHEMA, EVENT_COLUMNS, conform
from pacewise.sources.tables import Table

# Earliest ingest wins. Redeliveries carry identical values, so the extra keys only make the
# choice deterministic and never change a non-tied result.
DEDUP_ORDER = ("ingest_ts", "kafka_ts", "event_ts", "request_id")


def deduplicated(bronze: DataFrame) -> DataFrame:
    """Bronze rows with one row per event_id, provenance kept.

    Rows with a NULL event_id are dropped, never deduped into one. Rows are shuffled on ``event_id``
    before they are sorted: with the window alone Spark sorts them in the reading tasks as well (to cut
    copies down there), which spills them where a task reads many. The copies of one event, a handful as
    a rule, meet in one task; the ``row_number() = 1`` filter lets it keep one of them while it reads.
    """
    w = Window.partitionBy("event_id").orderBy(*[F.col(c).asc() for c in DEDUP_ORDER])
    return (
        bronze.where(F.col("event_id").isNotNull())
        .repartition("event_id")
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == 1)
        .drop("rn")
    )


def fact_event(bronze: DataFrame) -> DataFrame:
    """Bronze -> 10-column silver fact (L3: deduplicated, then the B1 projection)."""
    return deduplicated(bronze).select(*EVENT_COLUMNS)


def merge_events(spark: SparkSession, silver: Table, batch: DataFrame) -> int:
    """Adds to ``silver`` the events of a bronze batch that it does not hold yet (L3, I6); the rows added.

    The batch alone is deduplicated and compared with the (day, user bucket) partitions that its events
    fall into, late ones included; no other partition is read and no file is rewritten. Copies of an event
    carry equal values (redelivery), so they meet in one partition and the first one merged, the
    earliest ingested, stays. Merging a batch again adds nothing, also after a run that was cut short.
    """
    parts = list(silver.partition_by)
    fresh = silver.with_layout(fact_event(batch))
    keys = [r[0] for r in fresh.select(partition_key(parts)).distinct().collect()]
    if not keys:
        return 0
    spark.catalog.refreshByPath(silver.path)
    held = silver.read(spark, layout=True).where(in_partitions(parts, keys)).select("event_id")
    added = silver.write(fresh.join(held, "event_id", "left_anti"), mode="append")
    spark.catalog.refreshByPath(silver.path)
    return added


def dim_campaign(snapshot: DataFrame) -> DataFrame:
    """Campaign snapshot (ISO date strings) -> 7-column dimension."""
    out = snapshot.selectExpr(
        "campaign_id",
        "CAST(budget AS BIGINT) AS budget",
        "to_date(flight_start) AS flight_start",
        "to_date(flight_end) AS flight_end",
        "CAST(daily_budget AS DOUBLE) AS daily_budget",
        "target_geo",
        "target_device",
    )
    return conform(out, DIM_CAMPAIGN_SCHEMA)
