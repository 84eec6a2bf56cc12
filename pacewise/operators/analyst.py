"""Analyst queries over the gold and silver tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise.constants import AMPLIFY, QUARTILE_TYPES
from pacewise.functions import ratio
from pacewise.schemas import EVENT_COLUMNS


def pacing_leaderboard(pacing: DataFrame) -> DataFrame:
    """Latest row per campaign, rounded, ranked by pace_index.

    "Latest" keeps ties like an inner join to the per-campaign max does; it is computed with a
    max-over-partition window, so the table is shuffled once on campaign_id instead of twice.
    """
    latest = F.max("pacing_date").over(Window.partitionBy("campaign_id"))
    return (pacing.withColumn("latest_date", latest)
            .where(F.col("pacing_date") == F.col("latest_date"))
            .select("campaign_id", "pacing_date", "cumulative_delivered",
                    F.round("expected_pace", 1).alias("expected"),
                    F.round("pace_index", 3).alias("pace_index"), "pace_label")
            .orderBy(F.col("pace_index").desc_nulls_last(), "campaign_id"))


def fill_by_placement(fill: DataFrame) -> DataFrame:
    """Requests, impressions and overall fill rate per placement."""
    return (fill.groupBy("placement")
            .agg(F.sum("requests").alias("requests"), F.sum("impressions").alias("impressions"))
            .withColumn("fill_rate", F.round(ratio("impressions", "requests"), 3))
            .orderBy(F.col("fill_rate").desc_nulls_last(), "placement"))


def completion_funnel(delivery: DataFrame) -> DataFrame:
    """Impressions and the share completing each quartile."""
    return delivery.agg(
        F.count(F.lit(1)).alias("impressions"),
        *[F.round(F.avg(F.col(f"completed_{q}").cast("int")), 3).alias(f"{q}_rate")
          for q in QUARTILE_TYPES])


def bronze_smoke(bronze: DataFrame) -> DataFrame:
    """Rows, distinct event ids and distinct users of bronze (L10: D4, D5)."""
    return bronze.agg(F.count(F.lit(1)).alias("rows"),
                      F.countDistinct("event_id").alias("distinct_ids"),
                      F.countDistinct("user_id").alias("distinct_users"))


def silver_checks(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Events, distinct events, campaigns and events joining a campaign (L11: B16, D4, D5, C5).

    One pass over the events: each meets how many dimension rows its campaign has. The dimension's own
    count is a scalar subquery.
    """
    campaigns = dim.agg(F.count(F.lit(1))).scalar()
    held = dim.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("held"))
    return (silver.select("event_id", "campaign_id").join(held, "campaign_id", "left")
            .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("distinct_events"),
                 F.coalesce(F.sum("held"), F.lit(0)).alias("joinable_events"))
            .select("events", "distinct_events", campaigns.alias("campaigns"), "joinable_events"))


def top_users(events: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` users with most rows, ties broken by user_id (F3). A top-k report: the limit
    is the feature, planned as a TakeOrderedAndProject over the per-user counts."""
    return (events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.col("events").desc(), F.col("user_id").asc()).limit(k))


def amplify_blocks(silver: DataFrame, copies: int = AMPLIFY) -> DataFrame:
    """The rows of ``amplify``, each copy a block of rows apart from the next: copies side by side would let
    Parquet fold them, and the layout that is not clustered would look as if it were."""
    rows = silver.select(*EVENT_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("event_id")
            for rep in range(copies):
                ids = pc.binary_join_element_wise(batch.column(at), f"-{rep}", "")
                yield batch.set_column(at, batch.schema.field(at), ids)

    return rows.mapInArrow(run, rows.schema)


def amplify(silver: DataFrame, copies: int = AMPLIFY) -> DataFrame:
    """``copies`` distinct copies of every event, event_id made unique per copy.

    A generator over a literal sequence: narrow, no join, no shuffle.
    """
    return with_copies(silver, copies).select(*EVENT_COLUMNS)


def with_copies(rows: DataFrame, copies: int = AMPLIFY) -> DataFrame:
    """``amplify`` that keeps all columns and their order."""
    return (rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("rep"))
            .withColumn("event_id", F.concat(F.col("event_id"), F.lit("-"), F.col("rep").cast("string")))
            .select(*rows.columns))
