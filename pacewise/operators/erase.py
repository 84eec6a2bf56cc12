"""User erasure across the lake.

Input is always a *table* of user ids (one id = one row). Erasing rewrites single files: those that
hold a row of the users, found by one scan of ``user_id`` (on the bucketed silver layout, of the users'
buckets alone; on bronze and delivery, of the row groups that their Bloom filters and user order
leave). Each such file is written anew without the rows, by one task, and then moved over the old
one in one step, so a reader finds each file as it was or as it shall be, and a run lost half way
is finished by the next one, which finds the files that are left. A file without other rows is
deleted, and so is a partition folder without files. Every erase ends with a verification that
the users have no rows left.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pacewise.functions import is_valid_user_id, ratio, user_bucket
from pacewise.operators import gold
from pacewise.operators.maintenance import NULL_KEY, in_partitions, recover
from pacewise.operators.rewrite import check_stage, file_name, stage_files, stage_path, staged_files
from pacewise.session import checkpoint_root
from pacewise.sources import fs
from pacewise.sources.tables import Lake, Table

PII_TABLES = ("bronze", "silver", "delivery")
AGGREGATE_TABLES = ("fill", "pacing")


class UnsafeUserId(ValueError):
    """An id outside the allow-list ``[A-Za-z0-9_-]+``."""


@dataclass
class EraseCost:
    """What one erase rewrote (K4)."""

    table: str
    partitions_touched: int = 0
    partitions_emptied: int = 0
    files_rewritten: int = 0
    rows_rewritten: int = 0
    bytes_rewritten: int = 0
    rows_deleted: int = 0
    touched: list = field(default_factory=list, repr=False)  # partition values rewritten

    def report(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "touched"}


def validated_users(users: DataFrame) -> DataFrame:
    """Distinct user ids, after rejecting any id outside the allow-list."""
    bad = users.where(~is_valid_user_id("user_id")).select("user_id").limit(1).collect()
    if bad:
        raise UnsafeUserId(f"user id {bad[0][0]!r} has characters other than letters, digits, _ and -")
    return users.select("user_id").distinct()


def frozen_users(spark: SparkSession, users: DataFrame) -> DataFrame:
    """Validated ids written to the shared checkpoint folder.

    The list is often derived from a table about to be rewritten (e.g. "the top user of
    silver"); cutting the lineage keeps it stable and readable after that table changes.
    """
    checkpoint_root(spark)
    return validated_users(users).checkpoint(eager=True)


LOOKUP_IDS = 1_000  # so many ids at most are also a literal filter, which row groups are skipped by


def _users_rows(df: DataFrame, table: Table, users: DataFrame) -> DataFrame:
    """The users' rows: a semi join for any number of ids.

    On a bucketed table the users' buckets (at most ``USER_BUCKETS`` values) are a static
    partition filter, so the scan opens only those folders. Elsewhere a short list is a filter of the
    scan as well, which Parquet checks against each row group's statistics and Bloom filter; among more
    ids than ``LOOKUP_IDS`` nearly every row group holds one, and the join alone decides.
    """
    if "user_bucket" in table.partition_by:
        buckets = [r[0] for r in users.select(user_bucket("user_id")).distinct().collect()]
        df = df.where(F.col("user_bucket").isin(buckets))
    if "user_id" in table.lookup_by:
        ids = [r[0] for r in users.select("user_id").distinct().limit(LOOKUP_IDS + 1).collect()]
        if len(ids) <= LOOKUP_IDS:
            df = df.where(F.col("user_id").isin(ids))
    return df.join(users, "user_id", "left_semi")


@contextmanager
def _lookups(spark: SparkSession):
    """Lets scans hand lists of up to ``LOOKUP_IDS`` values to Parquet one by one, not as their range."""
    key = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), LOOKUP_IDS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remaining_rows(spark: SparkSession, table: Table, users: DataFrame) -> int:
    """Rows of ``users`` still readable in ``table``."""
    spark.catalog.refreshByPath(table.path)
    with _lookups(spark):
        return _users_rows(table.read(spark, layout=True), table, users).count()


def files_of(spark: SparkSession, table: Table, users: DataFrame) -> list[Row]:
    """The files that hold rows of ``users``: partition values, name, size, ``target`` (a number for the name)
    and how many of the rows are theirs (``erased``). Spark's own listing of the table holds as many entries."""
    scan = table.read(spark, layout=True).withColumn("file", file_name()).withColumn("size", F.col("_metadata.file_size"))
    with _lookups(spark):
        found = (_users_rows(scan, table, users).groupBy(*table.partition_by, "file", "size")
                 .agg(F.count(F.lit(1)).alias("erased"))
                 .withColumn("target", F.xxhash64("file").cast("string")).collect())
    if len({r["target"] for r in found}) < len(found):
        raise AssertionError("two files have one number")
    return found


def erase(spark: SparkSession, table: Table, users: DataFrame, verify: bool = True) -> EraseCost:
    """Delete every row of ``users`` from ``table`` by rewriting only the files that hold them (K1, K4)."""
    cost = EraseCost(table.name or table.path)
    recover(spark, table.path)
    if not table.exists(spark):
        return cost
    parts = list(table.partition_by)
    found = files_of(spark, table, users)
    if not found:
        return cost
    cost.touched = sorted({tuple(r[c] for c in parts) for r in found}, key=str)
    cost.partitions_touched = len(cost.touched)
    cost.files_rewritten = len(found)
    cost.bytes_rewritten = sum(r["size"] for r in found)
    cost.rows_deleted = sum(r["erased"] for r in found)

    old = {r["target"]: fs.plain(r["file"]) for r in found}
    rows = table.read_files(spark, list(old.values())).withColumn("target", F.xxhash64(file_name()).cast("string"))
    kept = rows.join(users, "user_id", "left_anti")
    stage = stage_path(table.path, "erase")
    written = stage_files(table, kept, stage)
    if written[0]:
        check_stage(spark, table, stage, written)
    cost.rows_rewritten = written[0] + cost.rows_deleted
    staged = staged_files(spark, stage)
    gone = [file for target, file in old.items() if target not in staged]
    fs.each(fs.replace, [(spark, staged[target], file) for target, file in old.items() if target in staged])
    fs.each(fs.delete, [(spark, file, False) for file in gone])
    for folder in {file.rsplit("/", 1)[0] for file in gone} if parts else ():
        if not fs.data_files(spark, folder):
            fs.delete(spark, folder)
            cost.partitions_emptied += 1
    fs.delete(spark, stage)
    spark.catalog.refreshByPath(table.path)
    if verify:
        left = remaining_rows(spark, table, users)
        if left:
            raise AssertionError(f"{cost.table}: {left} rows of erased users remain")
    return cost


# --- the erasure job (L12) -------------------------------------------------------------------------
def fill_of(spark: SparkSession, lake: Lake, users: DataFrame) -> DataFrame:
    """What ``users`` add to fill, checkpointed before their rows go (K8)."""
    theirs = _users_rows(lake.read("silver", layout=True), lake["silver"], users)
    checkpoint_root(spark)
    return gold.inventory_fill(theirs).drop("fill_rate").checkpoint()


_FILL_KEYS = ("campaign_id", "placement", "event_hour")


def without_users(fill: DataFrame, theirs: DataFrame) -> DataFrame:
    """Fill less the users' counts; a bucket that only they were in is gone."""
    side = theirs.select(*[F.col(c).alias(f"their_{c}") for c in theirs.columns])
    same = F.lit(True)
    for c in _FILL_KEYS:
        same = same & F.col(c).eqNullSafe(F.col(f"their_{c}"))
    left = lambda c: (F.col(c) - F.coalesce(F.col(f"their_{c}"), F.lit(0))).alias(c)
    counts = fill.join(side, same, "left").select(*_FILL_KEYS, left("requests"), left("impressions"))
    bad = (F.col("requests") < 0) | (F.col("impressions") < 0)
    counts = counts.withColumn("requests", F.when(bad, F.raise_error(F.lit("fill holds fewer events than the users have"))).otherwise(F.col("requests")))
    rest = counts.where((F.col("requests") > 0) | (F.col("impressions") > 0))
    return rest.withColumn("fill_rate", ratio("impressions", "requests"))


def refresh_fill_days(spark: SparkSession, lake: Lake, days: list, theirs: DataFrame | None = None) -> int:
    """Bring fill up to date for the silver days the erasure touched (K8).

    Fill is partitioned by the day of its hour, which is the day of the events it counts, so the touched
    silver days map one-to-one onto fill partitions; they are replaced with dynamic overwrite, and a day
    left without rows is deleted. With ``theirs`` (what the users had added) those counts are subtracted
    and silver is not read; without it the days are counted from silver again.
    """
    if not days:
        return 0
    table = lake["fill"]
    scope = in_partitions(["event_date"], [NULL_KEY if d is None else d.isoformat() for d in days])
    if theirs is None:
        fresh = gold.inventory_fill(lake.read("silver", layout=True).where(scope))
    else:
        fresh = without_users(lake.read("fill", layout=True).where(scope), theirs)
    fresh = fresh.select(*[f.name for f in table.contract.fields]).checkpoint()  # the days it reads are replaced
    present = {r[0] for r in fresh.select(F.col("event_hour").cast("date")).distinct().collect()}
    if present:
        table.write(fresh, mode="overwrite", dynamic=True)
    for d in days:
        if d not in present:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
            fs.delete(spark, f"{table.path}/event_date={name}")
    spark.catalog.refreshByPath(table.path)
    return len(days)


def stale_fill_days(lake: Lake) -> list:
    """Days whose stored fill differs from the fill of the silver table."""
    stored = lake.read("fill")
    fresh = gold.inventory_fill(lake.read("silver")).select(*stored.columns)
    differ = fresh.subtract(stored).unionByName(stored.subtract(fresh))
    return [r[0] for r in differ.select(F.col("event_hour").cast("date")).distinct().collect()]


def rebuild_pacing(spark: SparkSession, lake: Lake) -> int:
    """Pacing from the refreshed fill table (small: campaign x placement x hour)."""
    lake.write("pacing", gold.campaign_pacing_from_fill(lake.read("fill"), lake.read("dim_campaign")))
    n = lake.count("pacing")
    if n <= 0:
        raise AssertionError("pacing is empty after the erasure")
    return n


def record_erasure(spark: SparkSession, lake: Lake, users: DataFrame, tables: list[str]) -> None:
    """Append one audit row per user (A12); the log is never an erase target."""
    rows = users.select("user_id", F.lit(",".join(tables)).alias("tables"),
                        F.current_timestamp().cast("timestamp_ntz").alias("erased_at"))
    lake["erasure_log"].write(rows, mode="append")


def forget(spark: SparkSession, lake: Lake, users: DataFrame) -> dict:
    """Erase ``users`` from every layer (L12: K1, K8, K9, K10, A12, H20).

    Order: bronze, silver, delivery (bronze first, or a silver rebuild would resurrect the
    users), then the users' counts are subtracted from fill and pacing is built from fill. Every table is attempted
    even after a failure; the audit row lists only the tables fully erased and verified, and
    the job raises at the end if any table failed. A marker in the lake tells a later run that one
    before it didn't finish; that run compares all of fill with silver, because the days which the
    failed one touched are no longer known.
    """
    users = frozen_users(spark, users)
    marker = lake.folder("_control", "erase-unfinished")
    resumed = fs.exists(spark, marker)
    if not resumed:
        fs.write_text(spark, marker, "")
    done: list[str] = []
    failed: dict[str, str] = {}
    costs: dict[str, dict] = {}
    touched_days: list = []
    theirs = None if resumed else fill_of(spark, lake, users)  # after a failed run it is not known any more
    for name in PII_TABLES:
        try:
            cost = erase(spark, lake[name], users)
            costs[name] = cost.report()
            if name == "silver":
                touched_days = sorted({t[0] for t in cost.touched}, key=str)
            done.append(name)
        except Exception as exc:  # noqa: BLE001 - record and continue
            failed[name] = repr(exc)
    if "silver" in done:
        try:
            if resumed:
                touched_days = sorted({*touched_days, *stale_fill_days(lake)}, key=str)
            refresh_fill_days(spark, lake, touched_days, theirs)
            done.append("fill")
            rebuild_pacing(spark, lake)
            done.append("pacing")
        except Exception as exc:  # noqa: BLE001
            failed.update({n: repr(exc) for n in AGGREGATE_TABLES if n not in done})
    else:
        failed.update({n: "silver not erased; aggregates not rebuilt" for n in AGGREGATE_TABLES})
    record_erasure(spark, lake, users, done)
    lake.refresh()
    if failed:
        raise RuntimeError(f"erasure incomplete for {sorted(failed)}: {failed}")
    fs.delete(spark, marker, recursive=False)
    return {"tables": done, "costs": costs}


# --- deferred erasure: tombstones (K2, K3, C8) -----------------------------------------------------
def request_erasure(spark: SparkSession, lake: Lake, users: DataFrame) -> None:
    """Record the users as tombstones; data files stay untouched until reconciliation (K2)."""
    rows = validated_users(users).select(
        "user_id", F.current_timestamp().cast("timestamp_ntz").alias("requested_at"))
    lake["tombstones"].write(rows, mode="append")


def live(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """``name`` as readers see it: tombstoned users excluded at read time.

    An anti join on user_id, which the session's size threshold or AQE may turn into a broadcast.
    """
    tomb = lake.read("tombstones").select("user_id").distinct()
    return lake.read(name).join(tomb, "user_id", "left_anti")


def reconcile(spark: SparkSession, lake: Lake) -> dict:
    """Apply pending tombstones physically (K3), then remove exactly the tombstone files applied.

    Tombstones appended while this runs live in new files and stay pending.
    """
    table = lake["tombstones"]
    if not table.exists(spark):
        return {"applied_files": 0}
    scan = table.read(spark).withColumn("_file", F.col("_metadata.file_path"))
    files = [r["_file"] for r in scan.select("_file").distinct().collect()]
    users = frozen_users(spark, scan.where(F.col("_file").isin(files)).select("user_id"))
    result = forget(spark, lake, users)
    for f in files:
        fs.delete(spark, f, recursive=False)
    spark.catalog.refreshByPath(table.path)
    return {"applied_files": len(files), **result}
