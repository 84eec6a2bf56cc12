"""Side-effect jobs behind registered queries. Each runs the real job on its own lake under the
session's checkpoint folder and returns the resulting table; a job's lake is built once per
application and input folder, then reused by the queries that read it."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.constants import MIN_INPUT_FILES
from pacewise.operators import analyst, erase, layout
from pacewise.operators.maintenance import compact
from pacewise.operators.silver import dim_campaign, fact_event
from pacewise.plans import builders
from pacewise.schemas import BRONZE_SCHEMA, SchemaDriftError
from pacewise.session import fresh_dir
from pacewise.sources import given
from pacewise.sources.campaigns import land_campaign_snapshot, read_campaign_snapshot
from pacewise.sources.tables import Lake, silver_table
from pacewise.streaming import bronze as stream
from pacewise.streaming import ingest

_MEMO: dict[tuple, object] = {}


def _memo(spark: SparkSession, sf_dir: str, kind: str, make):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


def seeded_lake(spark: SparkSession, sf_dir: str, kind: str = "seeded") -> Lake:
    """A lake with bronze (fixture), dimension, silver and gold built by the builders."""
    def make() -> Lake:
        lake = Lake(spark, fresh_dir(spark, f"lake-{kind}"))
        builders.run(builders.BuildContext(spark, lake, sf_dir), "seeded")
        return lake
    return _memo(spark, sf_dir, kind, make)


def _top_user(df: DataFrame) -> DataFrame:
    return analyst.top_users(df, 1).select("user_id")


# --- erasure (L12) ---------------------------------------------------------------------------------
def forgotten_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A seeded lake after ``forget`` of its top user (most silver events, ties by id)."""
    def make() -> Lake:
        lake = seeded_lake(spark, sf_dir, "forget")
        erase.forget(spark, lake, _top_user(lake.read("silver")))
        return lake
    return _memo(spark, sf_dir, "forgotten", make)


def forgotten_table(name: str):
    return lambda spark, sf_dir: forgotten_lake(spark, sf_dir).read(name)


def erasure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows of that erasure without their time."""
    return forgotten_lake(spark, sf_dir).read("erasure_log").select("user_id", "tables")


def landed_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension rebuilt from landed JSON snapshots."""
    path = fresh_dir(spark, "campaigns")
    land_campaign_snapshot(given.dim(spark, sf_dir), path)
    return dim_campaign(read_campaign_snapshot(spark, path))


def tombstone_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as readers see it after a deferred erasure of the top user."""
    def make() -> Lake:
        base = seeded_lake(spark, sf_dir)
        lake = Lake(spark, base.root)
        lake.tables["tombstones"] = base["tombstones"].at(fresh_dir(spark, "tombstones"), "tombstones")
        erase.request_erasure(spark, lake, _top_user(lake.read("silver")))
        return lake
    return erase.live(spark, _memo(spark, sf_dir, "tombstoned", make), "silver")


def delete_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Erase the same user from a day+bucket copy and a day-only copy of silver (K4, K5)."""
    root = fresh_dir(spark, "delete-cost")
    src_path = f"{root}/source"
    given.silver(spark, sf_dir).write.mode("overwrite").parquet(src_path)
    src = spark.read.parquet(src_path)
    bucketed = silver_table(f"{root}/bucketed", True, "bucketed")
    by_day = silver_table(f"{root}/unbucketed", False, "unbucketed")
    bucketed.write(src)
    by_day.write(src)
    users = erase.validated_users(_top_user(src))
    user_id = users.first()["user_id"]
    cb = erase.erase(spark, bucketed, users)
    cu = erase.erase(spark, by_day, users)
    if cb.rows_deleted != cu.rows_deleted:
        raise AssertionError("one copy lost more rows than the other")
    rows = [dict(c.report(), user_id=user_id) for c in (cb, cu)]
    out = spark.createDataFrame(rows)
    ratio = lambda a, b: float(a) / b if b else None
    return out.withColumn("rows_ratio_unbucketed_over_bucketed",
                          F.lit(ratio(cu.rows_rewritten, cb.rows_rewritten)).cast("double")) \
              .withColumn("bytes_ratio_unbucketed_over_bucketed",
                          F.lit(ratio(cu.bytes_rewritten, cb.bytes_rewritten)).cast("double"))


# --- layout study (L13-L15) ------------------------------------------------------------------------
def layout_study(spark: SparkSession, sf_dir: str) -> layout.LayoutStudy:
    return _memo(spark, sf_dir, "layout",
                 lambda: layout.build_layout_study(spark, given.silver(spark, sf_dir),
                                                   fresh_dir(spark, "layout-study")))


def _optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_study(spark, sf_dir).optimized.read(spark, layout=True)


def top_user_id(df: DataFrame) -> str:
    """The top user as a literal (one row) so the user filter can prune partitions."""
    return _top_user(df).first()["user_id"]


def user_filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    opt = _optimized(spark, sf_dir)
    return layout.user_filtered_scan(opt, top_user_id(opt))


def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    opt = _optimized(spark, sf_dir)
    return layout.date_range_scan(opt, layout.first_day(opt).first()["day"])


def campaign_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.campaign_rollup(_optimized(spark, sf_dir))


def layout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = layout_study(spark, sf_dir)
    return layout.layout_report(spark, study.bad, "bad").unionByName(
        layout.layout_report(spark, study.optimized, "optimized"))


def scan_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes each layout query reads on each layout."""
    study = layout_study(spark, sf_dir)
    uid = top_user_id(study.optimized.read(spark))
    day = layout.first_day(study.optimized.read(spark, layout=True)).first()["day"]
    of = lambda label, table: layout.scan_volume(spark, table, uid, day).withColumn("layout", F.lit(label))
    return of("bad", study.bad).unionByName(of("optimized", study.optimized))


def scan_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each query and layout: whether it reads fewer bytes than a read of everything, and on the partitioned
    layout fewer than on the other one (L15, N9)."""
    path = fresh_dir(spark, "scan-volume")  # read several times below
    scan_volume(spark, sf_dir).write.parquet(path)
    volume = spark.read.parquet(path)
    whole = volume.where("query = 'everything'").select("layout", F.col("column_bytes").alias("whole"))
    bad = volume.where("layout = 'bad'").select("query", F.col("column_bytes").alias("bad"))
    rows = volume.where("query <> 'everything'").join(whole, "layout").join(bad, "query")
    return rows.select("query", "layout", (F.col("column_bytes") < F.col("whole")).alias("reads_less_than_everything"),
                       ((F.col("layout") == "bad") | (F.col("column_bytes") < F.col("bad"))).alias("gains_by_layout"),
                       (F.col("column_bytes") > 0).alias("reads_something"))


# --- streaming (L1) --------------------------------------------------------------------------------
BATCHES = 4  # micro-batches that a landed fixture is read in


def landed(spark: SparkSession, sf_dir: str, lake: Lake, batches: int | None = BATCHES, kind: str = "json", **land) -> DataFrame:
    """The fixture landed as envelopes in the lake, as a stream of so many micro-batches (without a number: of one)."""
    landing, rows = lake.folder("landing", "ad_events"), given.bronze(spark, sf_dir)
    files = stream.landing_files(rows, BATCHES)
    stream.land_envelopes(rows, landing, files=files, kind=kind, **land)
    return stream.file_source(spark, landing, max_files_per_trigger=files // batches if batches else None, kind=kind)


def stream_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Land the fixture as JSON envelopes and ingest them with an available-now stream, in
    four micro-batches, into a fresh lake's bronze."""
    def make() -> Lake:
        lake = Lake(spark, fresh_dir(spark, "lake-stream"))
        raw = landed(spark, sf_dir, lake)
        q = stream.start(spark, raw, lake["bronze"], lake.folder("_checkpoints", "bronze"), "ingest",
                         available_now=True)
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(f"bronze stream failed: {q.exception()}")
        return lake
    return _memo(spark, sf_dir, "stream", make)


def streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed bronze without ``ingest_ts`` (processing time)."""
    return stream_lake(spark, sf_dir).read("bronze").select(
        *[f.name for f in BRONZE_SCHEMA.fields if f.name != "ingest_ts"])


def streamed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rebuilt from the streamed bronze."""
    return fact_event(stream_lake(spark, sf_dir).read("bronze"))


# --- compaction (K6, K7) ---------------------------------------------------------------------------
def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written as many small files per partition, sort-compacted, read back."""
    table = silver_table(fresh_dir(spark, "compaction") + "/fact_event", name="fact_event")
    df = table.with_layout(given.silver(spark, sf_dir)).withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(2)))
    for part in (0, 1):  # two writes: two files in each partition at least
        table.write(df.where(F.col("part") == part).drop("part"), mode="append")
    compact(spark, table, min_input_files=MIN_INPUT_FILES, sort=True)
    return table.read(spark)


def small_pieces(large: Counter) -> tuple[int, int]:
    """Pieces of a day's small half, and tasks to write them: eight pieces for each of its large files (days -> files),
    so that a piece is about an eighth of one, and no task writes much more than two large files hold."""
    pieces = 8 * max(large.values())
    return pieces, max(16, pieces, sum(large.values()) // 2)


def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze landed as many small files beside one large file a day, packed to files of a target size (K6).

    A file's size is known only when it is written, so the target is taken from the files themselves:
    small ones are those below half of the mean of the large half's files. That half is more than one file a day
    where a day is large, so the small files are as many more; a file of it that is small itself (of a day with
    few rows) is packed like all small ones.
    """
    table = Lake(spark, fresh_dir(spark, "compaction"))["bronze"]
    rows = table.with_layout(given.bronze(spark, sf_dir), stream_tag="seed", batch_id=0).withColumn("kind", F.pmod(F.xxhash64("request_id"), F.lit(2)))
    large, small = rows.where("kind = 0").drop("kind"), rows.where("kind = 1").drop("kind")
    table.write(large)
    files = layout.file_stats(spark, table).select("ingest_date", "file_path", "file_size").collect()
    large_bytes = sum(r["file_size"] for r in files) // len(files)
    before = {r["file_path"] for r in files if r["file_size"] >= large_bytes // 2}
    pieces, tasks = small_pieces(Counter(r["ingest_date"] for r in files))
    keys = ["ingest_date", F.pmod(F.xxhash64("user_id"), F.lit(pieces))]
    small.repartition(tasks, *keys).write.mode("append").options(**table.file_options).partitionBy(*table.partition_by).parquet(table.path)
    spark.catalog.refreshByPath(table.path)
    first = compact(spark, table, MIN_INPUT_FILES, sort=True, small_bytes=large_bytes // 2, target_bytes=large_bytes)
    second = compact(spark, table, MIN_INPUT_FILES, sort=True, small_bytes=large_bytes // 2, target_bytes=large_bytes)
    after = {r["file_path"] for r in layout.file_stats(spark, table).select("file_path").collect()}
    if not first["partitions"] or second["partitions"] or not before <= after:
        raise AssertionError(f"compaction: {first}, then {second}; {len(before - after)} large files rewritten")
    return table.read(spark)


# --- deferred erasure, applied (K3) -------------------------------------------------------------------
def reconciled_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a deferred erasure of the top user was applied to the files of every layer."""
    lake = seeded_lake(spark, sf_dir, "reconcile")
    erase.request_erasure(spark, lake, _top_user(lake.read("silver")))
    erase.reconcile(spark, lake)
    return lake.read("silver")


# --- incremental silver (L3, I6) ----------------------------------------------------------------------
def incremental_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The landed fixture, ingested in four batches; each is merged into silver as it comes."""
    def make() -> Lake:
        lake = Lake(spark, fresh_dir(spark, "lake-incremental"))
        raw = landed(spark, sf_dir, lake)
        ingest.ingest(spark, lake, raw, available_now=True, silver=True, log=lambda line: None)
        return lake
    return _memo(spark, sf_dir, "incremental", make)


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver merged batch by batch: late events and redelivered copies fall into other batches than the first."""
    return incremental_lake(spark, sf_dir).read("silver")


def stream_broken_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a stream in which the records without an event id are cut off (I5): such a record is an
    all-NULL row that keeps its broker time; without ``ingest_ts``."""
    lake = Lake(spark, fresh_dir(spark, "lake-broken"))
    raw = landed(spark, sf_dir, lake, batches=None, broken=F.col("event_id").isNull())
    ingest.ingest(spark, lake, raw, available_now=True, log=lambda line: None)
    return lake.read("bronze").select(*[f.name for f in BRONZE_SCHEMA.fields if f.name != "ingest_ts"])


# --- tables by name (A5, A13) ---------------------------------------------------------------------------
def named_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions per campaign and day of the flight, from tables that SQL names; silver was replaced after
    it got its name."""
    lake = seeded_lake(spark, sf_dir, "named")
    names = lake.register(f"pw_{lake.root.rsplit('-', 1)[-1]}_")
    lake.replace("silver", lake.read("silver").where("event_type = 'impression'"))
    return spark.sql(f"""
        SELECT d.campaign_id, d.budget, f.event_date, count(*) AS impressions
        FROM {names['silver']} f JOIN {names['dim_campaign']} d ON f.campaign_id = d.campaign_id
        WHERE f.event_date BETWEEN d.flight_start AND d.flight_end
        GROUP BY d.campaign_id, d.budget, f.event_date""")


def stream_binary_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from records whose key and value are bytes, as Kafka's are (H2), folded every second batch (A2); instead
    of ``ingest_ts``, whether it is the time of this run (H3)."""
    lake = Lake(spark, fresh_dir(spark, "lake-binary"))
    raw = landed(spark, sf_dir, lake, kind="parquet")
    begun = spark.sql("SELECT current_timestamp()").first()[0]
    ingest.ingest(spark, lake, raw, available_now=True, fold_every=2, log=lambda line: None)
    now = F.current_timestamp().cast("timestamp_ntz")
    in_time = F.col("ingest_ts").between(F.lit(begun).cast("timestamp_ntz"), now)
    return lake.read("bronze").withColumn("ingested_now", in_time).drop("ingest_ts")


# --- files and refusals (A11, A16, A17, D13, H20) --------------------------------------------------------
def forced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout report of the copy that was forced into 500 files."""
    bad = layout.layout_report(spark, layout_study(spark, sf_dir).bad, "bad")
    sizes = (F.col("avg_file_bytes") * F.col("files") - F.col("total_bytes")).between(-1, 1) & (F.col("total_bytes") > 0)
    return bad.select("files", "rows", sizes.alias("sizes_add_up"))


def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lake refuses, with the rows its table has afterwards: an append that drifts from the contract in a name,
    a type or a missing column (A11), and an erasure that names an id outside the allow-list (H20)."""
    lake = Lake(spark, fresh_dir(spark, "lake-refusals"))
    events = given.silver(spark, sf_dir)
    lake.write("silver", events)
    drifts = {"another name": events.withColumnRenamed("geo", "region"), "another type": events.withColumn("event_ts", F.col("event_ts").cast("string")),
              "a missing column": events.drop("placement")}
    rows = []
    for case, df in drifts.items():
        try:
            lake.write("silver", df, mode="append")
            rows.append((case, False))
        except SchemaDriftError:
            rows.append((case, True))
    for case, bad in (("a quote", "x' OR '1'='1"), ("a line end", "usr-00001\n"), ("an empty id", "")):
        users = events.select("user_id").distinct().unionByName(spark.createDataFrame([(bad,)], "user_id string"))
        try:
            erase.erase(spark, lake["silver"], erase.validated_users(users))
            rows.append((case, False))
        except erase.UnsafeUserId:
            rows.append((case, True))
    left = lake.read("silver").agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame(rows, "refused_for string, refused boolean").withColumn("rows_left", left)


# --- checks of jobs (N9-N11) --------------------------------------------------------------------------
def layouts_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both layouts, and whether the partitioned one has fewer files and its user query opens fewer bytes."""
    study = layout_study(spark, sf_dir)
    sizes = {}
    uid = top_user_id(study.optimized.read(spark))
    for name, table in (("bad", study.bad), ("optimized", study.optimized)):
        stats = layout.file_stats(spark, table).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
        opened = (layout.prune_by_user(table.read(spark, layout=True).withColumn("file", F.col("_metadata.file_path"))
                                       .withColumn("size", F.col("_metadata.file_size")), uid)
                  .groupBy("file", "size").agg(F.count(F.lit(1))).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("opened")))
        sizes[name] = stats.select("files", "rows").withColumn("opened", opened.scalar())
    bad, optimized = (sizes[n].select(*[F.col(c).alias(f"{n}_{c}") for c in sizes[n].columns]) for n in sizes)
    both = bad.join(optimized)  # one row each
    return both.select("bad_rows", "optimized_rows", (F.col("optimized_files") < F.col("bad_files")).alias("fewer_files"),
                       (F.col("optimized_opened") < F.col("bad_opened")).alias("user_query_reads_less"))


def delete_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The erased user, the rows deleted from each copy, and whether the day-only copy rewrote 1.5 times as many rows."""
    cost = delete_cost(spark, sf_dir)
    of = lambda name, c: F.max(F.when(F.col("table") == name, F.col(c)))
    return cost.groupBy("user_id").agg(
        of("bucketed", "rows_deleted").alias("deleted_bucketed"), of("unbucketed", "rows_deleted").alias("deleted_unbucketed"),
        (of("unbucketed", "rows_rewritten") > 1.5 * of("bucketed", "rows_rewritten")).alias("over_floor"))


def deferred_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deferred erasure of the top user: rows readers see of them, rows still stored, and whether all files stay."""
    base = seeded_lake(spark, sf_dir)
    lake = Lake(spark, base.root)
    lake.tables["tombstones"] = base["tombstones"].at(fresh_dir(spark, "tombstones"), "tombstones")
    users = erase.frozen_users(spark, _top_user(lake.read("silver")))
    files = lambda: {(r["file_path"], r["file_size"]) for r in layout.file_stats(spark, lake["silver"]).collect()}
    before = files()
    erase.request_erasure(spark, lake, users)
    stored = lake.read("silver").join(users, "user_id", "left_semi").agg(F.count(F.lit(1))).scalar()
    seen = erase.live(spark, lake, "silver").join(users, "user_id", "left_semi").agg(F.count(F.lit(1))).scalar()
    return users.select("user_id", seen.alias("readable_rows"), stored.alias("stored_rows"), F.lit(files() == before).alias("files_unchanged"))
