"""Training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``documents``; the last returns the token ids of the finished corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.llm import bpe, decontaminate, linededup, neardup, quality
from pacewise.llm.common import hex_sha256, table
from pacewise.llm.queries import VOCABULARY
from pacewise.session import fresh_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: documents that fail the base rule or that the classifier rejects go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.rules(docs, model).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: later occurrences of three repeated lines go; a document left without any word goes too."""
    left = linededup.dedup_lines(docs)
    left = left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3 over rows, not ids: of each group of near-duplicate rows the one with the smallest id stays, once.

    A row with an id stays before one without. Rows with a null id or with an id that others have too are
    compared by their own text like all others, so each text that is near no other stays. Texts without words
    are near nothing; only rows equal in id and text are one, and those with a null id all stay.
    """
    path = fresh_dir(spark, "corpus-near_dedup-rows")  # fixed numbers: every later read sees the same
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    classes = neardup.near_duplicates(rows.select("__row", "text"), "__row")
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    alone = F.when(~F.coalesce(worded, F.lit(False)) & F.col("doc_id").isNotNull(), F.struct("doc_id", "text"))
    named = rows.select("__row", "doc_id", alone.alias("__alone")).join(classes, "__row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))["__row"].alias("__row")
    first = named.groupBy(F.when(F.col("__alone").isNull(), F.col("class_id")).alias("class"), "__alone").agg(least).select("__row")
    return rows.join(first, "__row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: documents that hold a passage of the benchmark go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: ids of every text left, with the digest of the text they decode to."""
    coded = bpe.encode_decode(docs.select("doc_id", "text"), VOCABULARY, lean=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        hex_sha256(F.col("decoded").cast("binary")).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# The trained classifier, the sketches and the vocabulary can't be stated in SQL; tests/llm holds each
# operator against brute force and the pipeline's decisions against its operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
