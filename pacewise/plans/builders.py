"""Named table builders and groups in dependency order (K11), with a check of the rows written.

``run(ctx, "all")`` rebuilds dimension, silver and the three gold tables; ``"maintenance"``
compacts every table. Each builder reads its inputs from the lake and fully replaces its
output (source and target are always different tables).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pacewise.operators import gold, silver
from pacewise.operators.maintenance import compact_all
from pacewise.sources import given
from pacewise.sources.campaigns import read_campaign_snapshot
from pacewise.sources.tables import Lake
from pacewise.streaming.bronze import write_batch


@dataclass
class BuildContext:
    spark: SparkSession
    lake: Lake
    sf_dir: str | None = None  # given tables, for the fixture bronze and dimension
    campaign_snapshot: str | None = None  # landed campaign JSON; else the fixture dimension
    log: Callable[[str], None] = lambda msg: None


def _replaced(ctx: BuildContext, name: str, df: DataFrame, must_have_rows: bool = True) -> int:
    """A full replace; without the rows that must be there the build fails and the old table stays."""
    n = ctx.lake.replace(name, df, must_have_rows)
    ctx.log(f"[{name}] wrote {n} rows")
    return n


def build_bronze_seed(ctx: BuildContext) -> int:
    """Land the fixture bronze (derived from the given events) as batch 0 of tag ``seed``."""
    n = write_batch(ctx.lake["bronze"], given.bronze(ctx.spark, ctx.sf_dir), "seed", 0)
    if n <= 0:
        raise AssertionError("bronze is empty after its seed; look at the given events")
    ctx.log(f"[bronze] wrote {n} rows")
    return n


def build_dim_campaign(ctx: BuildContext) -> int:
    if ctx.campaign_snapshot:
        dim = silver.dim_campaign(read_campaign_snapshot(ctx.spark, ctx.campaign_snapshot))
    else:
        dim = given.dim(ctx.spark, ctx.sf_dir)
    return _replaced(ctx, "dim_campaign", dim)


def build_fact_event(ctx: BuildContext) -> int:
    return _replaced(ctx, "silver", silver.fact_event(ctx.lake.read("bronze")), must_have_rows=False)


def build_delivery(ctx: BuildContext) -> int:
    return _replaced(ctx, "delivery", gold.impression_delivery(ctx.lake.read("silver")))


def build_fill(ctx: BuildContext) -> int:
    return _replaced(ctx, "fill", gold.inventory_fill(ctx.lake.read("silver")))


def build_pacing(ctx: BuildContext) -> int:
    """Pacing from the (small) fill table; equal to computing it from silver."""
    pacing = gold.campaign_pacing_from_fill(ctx.lake.read("fill"), ctx.lake.read("dim_campaign"))
    return _replaced(ctx, "pacing", pacing)


def run_maintenance(ctx: BuildContext) -> dict:
    report = compact_all(ctx.spark, ctx.lake)
    ctx.log(f"[maintenance] {report}")
    return report


BUILDERS: dict[str, Callable[[BuildContext], object]] = {
    "bronze_seed": build_bronze_seed,
    "dim_campaign": build_dim_campaign,
    "fact_event": build_fact_event,
    "gold_delivery": build_delivery,
    "gold_fill": build_fill,
    "gold_pacing": build_pacing,
    "maintenance": run_maintenance,
}
GROUPS: dict[str, list[str]] = {
    "silver": ["dim_campaign", "fact_event"],
    "gold": ["gold_delivery", "gold_fill", "gold_pacing"],
    "all": ["dim_campaign", "fact_event", "gold_delivery", "gold_fill", "gold_pacing"],
    "maintenance": ["maintenance"],
    "seeded": ["bronze_seed", "dim_campaign", "fact_event", "gold_delivery", "gold_fill", "gold_pacing"],
}


def run(ctx: BuildContext, target: str = "all") -> dict[str, object]:
    names = GROUPS.get(target, [target])
    return {name: BUILDERS[name](ctx) for name in names}
