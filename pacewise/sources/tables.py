"""Lake tables on Parquet: declared contract + explicit partition columns.

A partition transform of the source table format (``days(ts)``, ``bucket(16, user_id)``) becomes
an explicit derived column written with ``partitionBy``. Reads always pass the full schema, so
partition columns keep their declared types instead of being re-inferred from directory names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pacewise.constants import BAD_LAYOUT_FILES, SORT_KEYS
from pacewise.functions import user_bucket, utc_day
from pacewise.schemas import (
    BRONZE_SCHEMA,
    DELIVERY_SCHEMA,
    DIM_CAMPAIGN_SCHEMA,
    ERASURE_LOG_SCHEMA,
    FILL_SCHEMA,
    LAYOUT_COLUMNS,
    PACING_SCHEMA,
    SILVER_SCHEMA,
    TOMBSTONE_SCHEMA,
    SchemaDriftError,
    check_schema,
)
from pacewise.sources import fs

Derivation = Callable[[], Column]

# Bronze and delivery have no user partition: their files are sorted by user, so of a day's files few hold
# one user, and each row group has a Bloom filter on it.
USER_KEYS = ("user_id",)


OPEN_FILES = 512  # files that a task of a write with ``copied`` keeps open; beyond, Spark sorts the rest by partition


@contextmanager
def open_at_once(spark: SparkSession, files: int) -> Iterator[None]:
    """Lets each writing task keep so many partitions' files open (0: as the session says)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(files) if files else before)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class Table:
    """A Parquet table at ``path`` with a fixed contract and an explicit partition layout."""

    path: str
    contract: StructType
    partition_by: tuple[str, ...] = ()
    layout: StructType = field(default_factory=StructType)
    derive: tuple[tuple[str, Derivation], ...] = ()
    cluster_by: tuple[str, ...] = ()
    name: str = ""
    lookup_by: tuple[str, ...] = ()  # columns with a Parquet Bloom filter in every row group

    @property
    def read_schema(self) -> StructType:
        names = {f.name for f in self.contract.fields}
        return StructType(list(self.contract.fields)
                          + [f for f in self.layout.fields if f.name not in names])

    def at(self, path: str, name: str | None = None) -> Table:
        """The same table definition at another location (a copy, a staging folder)."""
        return Table(path, self.contract, self.partition_by, self.layout, self.derive,
                     self.cluster_by, name or self.name, self.lookup_by)

    def exists(self, spark: SparkSession) -> bool:
        return fs.has_data_files(spark, self.path)

    def read(self, spark: SparkSession, layout: bool = False) -> DataFrame:
        """Scan with the declared schema; ``layout=True`` keeps the partition columns."""
        if not self.exists(spark):
            df = spark.createDataFrame([], self.read_schema)
        else:
            df = (spark.read.schema(self.read_schema).option("basePath", self.path)
                  .parquet(self.path))
        cols = [f.name for f in (self.read_schema if layout else self.contract).fields]
        return df.select(*cols)

    def with_layout(self, df: DataFrame, **values) -> DataFrame:
        """Add the partition columns: constants from ``values``, the rest derived."""
        out = df
        for name, value in values.items():
            t = self.layout[name].dataType
            out = out.withColumn(name, F.lit(value).cast(t))
        for name, fn in self.derive:
            if name not in values:
                out = out.withColumn(name, fn())
        return out

    def read_files(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """``read(layout=True)`` of some of the table's files alone."""
        return (spark.read.schema(self.read_schema).option("basePath", self.path).parquet(*files)
                .select(*[f.name for f in self.read_schema.fields]))

    @property
    def file_options(self) -> dict[str, str]:
        """Writer options of the table's files: Bloom filters sized by the distinct values that a row group has."""
        options = {"parquet.bloom.filter.adaptive.enabled": "true"} if self.lookup_by else {}
        return options | {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.lookup_by}

    def write(self, df: DataFrame, mode: str = "overwrite", dynamic: bool = False,
              check: bool = True, copied: Callable[[DataFrame], DataFrame] | None = None, **values) -> int:
        """Write ``df`` (contract columns, or contract + layout columns) to the table; the rows written.

        Rows are rebalanced on the partition columns before the write: AQE splits a hot
        partition value over several tasks and merges small ones, so each task writes few,
        well-sized files even when one key holds a large share of the rows. The rows are counted by the
        writing tasks themselves (an observation behind the last shuffle, so a lost map task counts once).

        ``copied`` makes several rows of one in the writing tasks, in place and in the same partition: the
        shuffle and the sort carry one. Their order is then nothing that Spark knows of, so each task keeps
        its partitions' files open at once instead of sorting all copies by partition.
        """
        present = set(df.columns)
        if missing := [c.name for c in self.contract.fields if c.name not in present]:
            raise SchemaDriftError(f"{self.name or self.path}: no column {', '.join(missing)}")
        base = df.select(*[c.name for c in self.contract.fields])
        if check:
            check_schema(base, self.contract, self.name or self.path)
        if self.partition_by and all(c in present for c in self.partition_by):
            out = df.select(*[f.name for f in self.read_schema.fields])
        else:
            out = self.with_layout(base, **values).select(*[f.name for f in self.read_schema.fields])
        out = out.hint("rebalance", *self.partition_by) if self.partition_by else out.hint("rebalance")
        if self.partition_by or self.cluster_by:
            out = out.sortWithinPartitions(*self.partition_by, *self.cluster_by)
        if copied:
            out = copied(out)
        seen = Observation()
        writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**self.file_options)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        with open_at_once(df.sparkSession, OPEN_FILES if copied else 0):
            writer.parquet(self.path)
        return int(seen.get["rows"])

    def write_unpartitioned_files(self, df: DataFrame, files: int = BAD_LAYOUT_FILES,
                                  copied: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Forced file count, no partitioning (A16): the deliberately bad layout. Rows go to files by hash of
        all their columns; ``copied`` makes several rows of one in the writing tasks."""
        columns = [c.name for c in self.contract.fields]
        copied(df.select(*columns).repartition(files, F.xxhash64(*columns))).write.mode("overwrite").parquet(self.path)


def _fields(schema: StructType) -> tuple[str, ...]:
    return tuple(f.name for f in schema.fields)


def _table(path: str, contract: StructType, layout_key: str | None,
           derive: tuple[tuple[str, Derivation], ...] = (), partition_by: tuple[str, ...] | None = None,
           cluster_by: tuple[str, ...] = (), name: str = "", lookup_by: tuple[str, ...] = ()) -> Table:
    layout = LAYOUT_COLUMNS[layout_key] if layout_key else StructType()
    parts = partition_by if partition_by is not None else _fields(layout)
    return Table(path, contract, parts, layout, derive, cluster_by, name, lookup_by)


def silver_table(path: str, bucketed: bool = True, name: str = "silver") -> Table:
    """Silver layout: ``days(event_ts)`` and, by default, ``bucket(16, user_id)``, sorted by
    campaign and time inside each file."""
    if bucketed:
        return _table(path, SILVER_SCHEMA, "silver",
                      (("event_date", lambda: utc_day("event_ts")),
                       ("user_bucket", lambda: user_bucket("user_id"))),
                      cluster_by=SORT_KEYS, name=name)
    return _table(path, SILVER_SCHEMA, "silver_by_day", (("event_date", lambda: utc_day("event_ts")),),
                  cluster_by=SORT_KEYS, name=name)


def flat_table(path: str, contract: StructType = SILVER_SCHEMA, name: str = "") -> Table:
    return Table(path, contract, name=name)


# Tables that a build replaces as a whole; the others only grow.
REPLACED = ("silver", "dim_campaign", "delivery", "fill", "pacing")
_VERSION = re.compile(r"__v(\d{6})$")


class Lake:
    """The layer folders (``bronze/ silver/ gold/ gdpr/``) under one root.

    A full replace writes a folder of its own, ``<table>__v<number>``; the highest number is the table. The
    folder gets that name in one step, after it was written and checked, so a build that is lost or fails
    before leaves the old table as it was. The folder before it goes at once: no old version keeps erased
    rows. ``register`` names the tables in Spark's session catalog; a replace then moves the name.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names: dict[str, str] = {}  # tables named in the session catalog
        r = self.root
        self.tables: dict[str, Table] = {
            "bronze": _table(f"{r}/bronze/ad_events_raw", BRONZE_SCHEMA, "bronze",
                             (("ingest_date", lambda: utc_day("ingest_ts")),), cluster_by=USER_KEYS, name="bronze", lookup_by=USER_KEYS),
            "silver": silver_table(f"{r}/silver/fact_event"),
            "dim_campaign": _table(f"{r}/silver/dim_campaign", DIM_CAMPAIGN_SCHEMA, None,
                                   name="dim_campaign"),
            "delivery": _table(f"{r}/gold/fact_impression_delivery", DELIVERY_SCHEMA, "delivery",
                               (("impression_date", lambda: utc_day("impression_ts")),),
                               cluster_by=USER_KEYS, name="delivery", lookup_by=USER_KEYS),
            "fill": _table(f"{r}/gold/inventory_fill", FILL_SCHEMA, "fill",
                           (("event_date", lambda: utc_day("event_hour")),), name="fill"),
            "pacing": _table(f"{r}/gold/campaign_pacing", PACING_SCHEMA, None,
                             partition_by=("campaign_id",), name="pacing"),
            "erasure_log": _table(f"{r}/gdpr/erasure_log", ERASURE_LOG_SCHEMA, None, name="erasure_log"),
            "tombstones": _table(f"{r}/gdpr/tombstones", TOMBSTONE_SCHEMA, None, name="tombstones"),
        }

    def __getitem__(self, name: str) -> Table:
        table = self.tables[name]
        found = self._versions(name)
        return table.at(f"{table.path}__v{found[-1]:06d}") if found else table

    def _versions(self, name: str) -> list[int]:
        if name not in REPLACED:
            return []
        parent, base = self.tables[name].path.rsplit("/", 1)
        names = fs.list_names(self.spark, parent, f"{base}__v")
        return sorted(int(m[1]) for n in names if (m := _VERSION.search(n)) and n[:m.start()] == base)

    def read(self, name: str, layout: bool = False) -> DataFrame:
        return self[name].read(self.spark, layout)

    def write(self, name: str, df: DataFrame, **kw) -> int:
        """The rows written; without options a full replace of a table that builds replace."""
        return self[name].write(df, **kw) if kw or name not in REPLACED else self.replace(name, df)

    def replace(self, name: str, df: DataFrame, must_have_rows: bool = False) -> int:
        """Replaces the table as a whole (A6); the rows written. Where they must be some, the old table stays if there are none."""
        base, old = self.tables[name], self._versions(name)
        parent, folder = base.path.rsplit("/", 1)
        for left in fs.list_names(self.spark, parent, f"{folder}__stage_"):
            fs.delete(self.spark, f"{parent}/{left}")
        staged = base.at(f"{base.path}__stage_{uuid.uuid4().hex[:10]}")
        n = staged.write(df)
        if must_have_rows and n <= 0:
            fs.delete(self.spark, staged.path)
            raise AssertionError(f"{name} is empty after its build; look at the tables it reads")
        target = f"{base.path}__v{(old[-1] if old else 0) + 1:06d}"
        fs.rename(self.spark, staged.path, target)
        if name in self.names:
            self.spark.sql(f"ALTER TABLE {self.names[name]} SET LOCATION '{target}'")
        for path in (base.path, *[f"{base.path}__v{v:06d}" for v in old]):
            fs.delete(self.spark, path)
        self.refresh()
        return n

    def register(self, prefix: str = "") -> dict[str, str]:
        """Names every table in the session catalog, as ``<prefix><layer>.<table>`` over its folder."""
        # partitions are found in the folders, so that moving a table's location is one change
        self.spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
        for name, base in self.tables.items():
            layer, table = base.path.rsplit("/", 2)[-2:]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
            self.names[name] = f"{prefix}{layer}.{table}"
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names[name]}")  # external: the files stay
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.read_schema.fields)
            parts = f"PARTITIONED BY ({', '.join(base.partition_by)})" if base.partition_by else ""
            self.spark.sql(f"CREATE TABLE {self.names[name]} ({columns}) USING parquet {parts} LOCATION '{self[name].path}'")
        return dict(self.names)

    def refresh(self) -> None:
        """Lets the names see files that were replaced."""
        for table in self.names.values():
            self.spark.catalog.refreshTable(table)

    def count(self, name: str) -> int:
        """Read-back count after a write."""
        return self.read(name).count()

    def folder(self, *parts: str) -> str:
        return "/".join([self.root, *parts])
