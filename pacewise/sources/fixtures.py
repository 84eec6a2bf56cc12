"""The ad-event fixture, derived deterministically from the given ``events`` and ``nation`` tables.

``events`` has no request linkage, duplicates or late rows, so each row becomes one ad-request
session of up to six events (request, impression, four quartiles). The derivation is narrow:
one scan and two generators (``inline`` of the session steps, ``explode`` of the redelivery
copies); no shuffle, so it scales with the input like a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.constants import DEVICES, EVENT_TYPES, GEOS, PLACEMENTS
from pacewise.functions import seconds
from pacewise.schemas import BRONZE_SCHEMA, DIM_CAMPAIGN_SCHEMA, conform

# --- fixed values: session steps (event type, offset in seconds from the source row) -------
STEP_OFFSETS = (0, 1, 3, 5, 7, 9)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index]`` for a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + F.lit(1))


def _code(prefix: str, n: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", n))


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows (12-column contract) for the given ``events`` table.

    Fill is 70 %, quartiles are nested, 1 session in 997 is malformed (NULL event_id), about
    5 % of events arrive late and 2 % are redelivered with a later ``ingest_ts``.
    """
    e, u = F.col("e"), F.col("u")
    steps = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(t).alias("step_type"), F.lit(o).alias("offset"))
        for i, (t, o) in enumerate(zip(EVENT_TYPES, STEP_OFFSETS))
    ])
    step = F.col("step")
    kept = (step == 0) | ((e % 10 < 7) & (step - 1 <= F.expr("(e div 10) % 5")))
    redelivered = (e * 6 + step) % 50 == 0
    on_time = F.col("ts") + seconds(F.col("offset"))
    late = (e + 7 * step) % 20 == 3
    event_ts = F.when(late, on_time - seconds(60 * (2 + e % 239))).otherwise(on_time)
    sessions = (
        events.select(F.col("event_id").alias("e"), F.col("user_id").alias("u"), "ts")
        .select("e", "u", "ts", F.inline(steps))
        .where(kept)
        .select("*", F.explode(F.when(redelivered, F.array(F.lit(0), F.lit(1)))
                               .otherwise(F.array(F.lit(0)))).alias("copy"))
    )
    out = sessions.select(
        F.when(e % 997 == 500, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("evt-"), e.cast("string"), F.lit("-"), step.cast("string")))
         .alias("event_id"),
        F.col("step_type").alias("event_type"),
        event_ts.alias("event_ts"),
        _code("cmp-", (u + e) % 20 + 1, 3).alias("campaign_id"),
        _code("crv-", (u + e) % 60 + 1, 3).alias("creative_id"),
        F.concat(F.lit("req-"), e.cast("string")).alias("request_id"),
        _code("usr-", u, 5).alias("user_id"),
        _pick(DEVICES, e % 3).alias("device"),
        _pick(GEOS, u % 5).alias("geo"),
        _pick(PLACEMENTS, F.expr("(e div 3) % 4")).alias("placement"),
        on_time.alias("kafka_ts"),
        (on_time + seconds(5 + 60 * F.col("copy"))).alias("ingest_ts"),
    )
    return conform(out, BRONZE_SCHEMA)


def dim_from_nation(nation: DataFrame) -> DataFrame:
    """The 20-row campaign dimension (7-column contract) from ``nation`` keys 0..19.

    Budget 0 on the last campaign exercises the NULL pace index.
    """
    n = F.col("n_nationkey")
    start = F.date_add(F.lit("2024-01-03").cast("date"), (n % 10).cast("int"))
    end = F.date_add(F.lit("2024-01-20").cast("date"), (n % 12).cast("int"))
    budget = F.when(n == 19, F.lit(0)).otherwise(130 + 10 * n).cast("bigint")
    out = (
        nation.where(n < 20)
        .select(
            _code("cmp-", n + 1, 3).alias("campaign_id"),
            budget.alias("budget"),
            start.alias("flight_start"),
            end.alias("flight_end"),
            F.round(budget.cast("double") / F.nullif(F.datediff(end, start), F.lit(0)), 2)
             .alias("daily_budget"),
            _pick(GEOS, n % 5).alias("target_geo"),
            _pick(DEVICES, n % 3).alias("target_device"),
        )
    )
    return conform(out, DIM_CAMPAIGN_SCHEMA)
