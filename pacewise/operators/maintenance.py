"""Small-file compaction and sort-compaction (K6, K7).

The small files of a partition are packed into bins by the running sum of their sizes; each bin is written
as one file in a sibling staging folder (optionally sorted by the table's clustering keys), checked by row
count and content hash, and only then swapped in: the new files move in first, the old ones go last, and
a manifest lets the next run finish a swap that was cut short. Nothing is replaced when the check fails.
Run with no concurrent readers or writers of the same partitions: without table snapshots a reader in the
instant of the swap could see both versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacewise.constants import MIN_INPUT_FILES, SMALL_FILE_BYTES, TARGET_FILE_BYTES
from pacewise.operators.layout import file_stats
from pacewise.operators.rewrite import STAGES, check_stage, stage_files, stage_path, staged_files
from pacewise.sources import fs
from pacewise.sources.tables import Lake, Table


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and the sum of per-row 64-bit hashes (order-free, computed on the cluster)."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0))
                 .alias("h")).first()
    return int(row["n"]), int(row["h"])


NULL_KEY = "\u0000"  # the key of a NULL partition value


def partition_key(cols: list[str]) -> Column:
    """The partition values of a row as one string."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in cols])


def in_partitions(cols: list[str], keys: list[str]) -> Column:
    """True for the rows of the partitions with these keys.

    One flat set lookup on partition columns alone: the scan prunes folders with it, and its depth
    does not grow with the number of partitions.
    """
    return partition_key(cols).isin(keys) if cols else F.lit(True)


# --- crash-safe folder swap ------------------------------------------------------------------------
def swap_folders(spark: SparkSession, table_path: str, moves: list[tuple[str, str]], drops: list[str]) -> None:
    """Replace folders: each ``(staged, target)`` move replaces ``target``; ``drops`` are removed.

    A manifest (``_swap_<id>.json``, ignored by readers) is written first, so a driver lost in
    the middle is finished by ``recover`` on the next run (roll forward: the staged data was
    already verified).
    """
    manifest = f"{table_path.rstrip('/')}/_swap_{uuid.uuid4().hex[:10]}.json"
    fs.write_text(spark, manifest, json.dumps({"moves": moves, "drops": drops}))
    _apply(spark, moves, drops)
    fs.delete(spark, manifest, recursive=False)


def _apply(spark: SparkSession, moves: list, drops: list) -> None:
    """All moves, then the drops: at no time is a row missing. Done again, it goes on where it was left."""
    fs.each(_move, [(spark, staged, target) for staged, target in moves])
    fs.each(fs.delete, [(spark, d) for d in drops])


def _move(spark: SparkSession, staged: str, target: str) -> None:
    parent, name = target.rstrip("/").rsplit("/", 1)
    aside = f"{parent}/.old-{name}"  # a leading dot hides the folder from readers
    if fs.exists(spark, staged):
        if fs.exists(spark, target):
            fs.delete(spark, aside)
            fs.rename(spark, target, aside)
        try:
            fs.rename(spark, staged, target)
        except Exception:
            if fs.exists(spark, aside) and not fs.exists(spark, target):
                fs.rename(spark, aside, target)
            raise
    if fs.exists(spark, target):
        fs.delete(spark, aside)


def recover(spark: SparkSession, table_path: str) -> int:
    """Finish any swap a lost driver left half done, and remove stages that no swap needs any more."""
    names = fs.list_names(spark, table_path, "_swap_")
    for name in names:
        path = f"{table_path.rstrip('/')}/{name}"
        plan = json.loads(fs.read_text(spark, path))
        _apply(spark, [tuple(m) for m in plan["moves"]], plan["drops"])
        fs.delete(spark, path, recursive=False)
    parent, name = table_path.rstrip("/").rsplit("/", 1)
    for stage in STAGES:
        for left in fs.list_names(spark, parent, name + stage):
            fs.delete(spark, f"{parent}/{left}")
    return len(names)


COMPACTED = "compact-"  # names of files that a compaction wrote


def bins(spark: SparkSession, table: Table, min_input_files: int, skip_latest: str | None,
         small_bytes: int, target_bytes: int) -> DataFrame:
    """(file, bin, rows): the small files of each partition, packed in bins of about ``target_bytes``.

    A file's bin is the whole part of what the small files before it, in name order, take up: of the
    target size, or of the session's ``maxRecordsPerFile`` where that is reached first. A partition is
    packed when ``min_input_files`` of its small files were not written by a compaction, and then whole, so
    that a second run finds nothing to do.
    """
    parts = list(table.partition_by)
    stats = file_stats(spark, table)
    if skip_latest:
        newest = F.max(skip_latest).over(Window.partitionBy(*parts[:parts.index(skip_latest)]))
        stats = stats.withColumn("newest", newest).where(F.col(skip_latest) < F.col("newest"))
    most_rows = int(spark.conf.get("spark.sql.files.maxRecordsPerFile", "0"))
    share = F.col("file_size") / F.lit(float(target_bytes))
    if most_rows > 0:
        share = F.greatest(share, F.col("rows") / F.lit(float(most_rows)))
    small = stats.withColumn("share", share).where((F.col("file_size") < small_bytes) & (F.col("share") < 1))
    new = (~F.substring_index("file_path", "/", -1).startswith(COMPACTED)).cast("int")
    small = small.withColumn("new", F.sum(new).over(Window.partitionBy(*parts))).where(F.col("new") >= min_input_files)
    before = Window.partitionBy(*parts).orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    packed = small.withColumn("no", F.floor(F.coalesce(F.sum("share").over(before), F.lit(0.0))))
    bin_key = F.xxhash64(partition_key(parts) if parts else F.lit(""), "no").cast("string")
    return packed.select(F.col("file_path").alias("file"), bin_key.alias("bin"), "rows")


def compact(spark: SparkSession, table: Table, min_input_files: int = MIN_INPUT_FILES,
            sort: bool = False, skip_latest: str | None = None,
            small_bytes: int = SMALL_FILE_BYTES, target_bytes: int = TARGET_FILE_BYTES) -> dict[str, int]:
    """Merge the small files of each partition into files of about ``target_bytes`` (K6).

    Only files below ``small_bytes`` are read and replaced, bin by bin (``bins``); larger ones stay as they
    are, and a second run finds nothing to do. The new files are checked by row count and content hash
    against what the writing tasks saw before anything is replaced.

    ``sort`` clusters rows by the table's ``cluster_by`` keys inside each file (K7);
    ``skip_latest`` names a partition column whose newest value under the columns before it is left
    alone (the last batch of every stream tag, which a restart may replay).
    """
    none = {"partitions": 0, "files_before": 0, "files_after": 0}
    recover(spark, table.path)
    if not table.exists(spark):
        return none
    found = (bins(spark, table, min_input_files, skip_latest, small_bytes, target_bytes)
             .groupBy("bin").agg(F.collect_list("file").alias("files"), F.sum("rows").alias("rows")).collect())
    if not found:
        return none
    old = {r["bin"]: [fs.plain(f) for f in r["files"]] for r in found}
    files = [f for group in old.values() for f in group]
    named = spark.createDataFrame([(f, r["bin"]) for r in found for f in r["files"]], "file string, target string")
    rows = table.read_files(spark, files).withColumn("file", F.col("_metadata.file_path")).join(named, "file").drop("file")
    stage = stage_path(table.path, "compact")
    written = stage_files(table, rows, stage, sort)
    if written[0] != sum(r["rows"] for r in found):
        raise AssertionError(f"compaction of {table.path} read {sum(r['rows'] for r in found)} rows and wrote {written[0]}")
    check_stage(spark, table, stage, written)
    staged = staged_files(spark, stage)
    run = uuid.uuid4().hex[:10]
    moves = [(staged[k], f"{group[0].rsplit('/', 1)[0]}/{COMPACTED}{run}-{i}.parquet") for i, (k, group) in enumerate(old.items())]
    swap_folders(spark, table.path, moves, files)
    fs.delete(spark, stage)
    spark.catalog.refreshByPath(table.path)
    folders = {f.rsplit("/", 1)[0] for f in files}
    return {"partitions": len(folders), "files_before": len(files), "files_after": len(moves)}


def merge_batches(spark: SparkSession, bronze: Table, tag: str, target_bytes: int = TARGET_FILE_BYTES) -> dict[str, int]:
    """Fold the committed micro-batch folders of one stream tag into one folder (bronze K6).

    Every batch but the newest (the only one a restart can replay) is rewritten into a single
    folder named after the highest batch it holds; later batches always get larger ids, so no
    future write lands in it. Folders that have grown to ``target_bytes`` are left, so a run folds what has
    come since, not the history. Verified by count and content hash before the swap.
    """
    from pacewise.streaming.bronze import batch_table  # local: streaming imports tables

    recover(spark, bronze.path)
    tag_dir = f"{bronze.path.rstrip('/')}/stream_tag={tag}"
    batches = sorted(int(n.split("=", 1)[1]) for n in fs.list_names(spark, tag_dir, "batch_id="))
    sizes = (file_stats(spark, bronze).where(F.col("stream_tag") == tag).groupBy("batch_id")
             .agg(F.sum("file_size").alias("bytes")).where(F.col("bytes") >= target_bytes).select("batch_id"))
    grown = {r[0] for r in sizes.collect()}  # folders of target size and more are not folded again
    olds = [b for b in batches[:-1] if b not in grown]
    if len(olds) < 2:
        return {"merged_batches": 0}
    target = olds[-1]
    selected = (bronze.read(spark, layout=True)
                .where((F.col("stream_tag") == tag) & F.col("batch_id").isin(olds))
                .drop("stream_tag", "batch_id"))
    stage_root = stage_path(bronze.path, "merge")
    staged = batch_table(bronze.at(stage_root), tag, target)
    staged.write(selected, mode="overwrite")
    if fingerprint(selected) != fingerprint(staged.read(spark, layout=True)):
        raise AssertionError(f"batch merge of {tag_dir} changed the data; staging kept at {stage_root}")
    swap_folders(spark, bronze.path, [(staged.path, f"{tag_dir}/batch_id={target}")],
          [f"{tag_dir}/batch_id={b}" for b in olds[:-1]])
    fs.delete(spark, stage_root)
    spark.catalog.refreshByPath(bronze.path)
    return {"merged_batches": len(olds), "into_batch": target}


def compact_all(spark: SparkSession, lake: Lake, min_input_files: int = MIN_INPUT_FILES) -> dict:
    """Maintenance over every lake table (K6); bronze keeps its newest batch untouched."""
    report = {}
    for tag in [n.split("=", 1)[1] for n in fs.list_names(spark, lake["bronze"].path, "stream_tag=")]:
        report[f"bronze[{tag}] batches"] = merge_batches(spark, lake["bronze"], tag)
    for name in lake.tables:
        table, skip = lake[name], "batch_id" if name == "bronze" else None
        report[name] = compact(spark, table, min_input_files, sort=bool(table.cluster_by), skip_latest=skip)
    lake.refresh()
    return report
