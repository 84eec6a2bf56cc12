"""Driver contract and lake invariants."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from pacewise.operators import checks
from pacewise.plans import builders, catalog, oracle
from pacewise.schemas import PACING_SCHEMA, SchemaDriftError, check_schema
from pacewise.session import fresh_dir
from pacewise.sources.tables import Lake


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == [f.name for f in PACING_SCHEMA.fields]
    assert df.count() > 0


def test_every_query_has_a_name_and_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"layout_report", "scan_volume", "delete_cost"} == set(catalog.queries()) - set(oracle.oracle_sql())


def test_seeded_lake_invariants(spark):
    lake = Lake(spark, fresh_dir(spark, "t-inv"))
    counts = builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    assert counts["bronze_seed"] > counts["fact_event"] > 0          # N1: bronze keeps duplicates
    smoke = lake.read("bronze").agg(F.count(F.lit(1)), F.countDistinct("event_id")).first()
    assert smoke[0] > smoke[1]
    report = checks.violations(lake.read("silver"), lake.read("dim_campaign"), lake.read("delivery"),
                               lake.read("fill"), lake.read("pacing"))
    checks.assert_clean(report)


def test_schema_drift_is_refused(spark):
    df = spark.createDataFrame([("x",)], "campaign_id string")
    try:
        check_schema(df, PACING_SCHEMA, "pacing")
    except SchemaDriftError:
        return
    raise AssertionError("drift not detected")
