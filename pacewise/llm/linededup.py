"""Op 5: removal of repeated lines by overlapping three-line windows.

Every three consecutive lines of a document are hashed (two 64-bit hashes). A window that occurred
before, in document order and then line order, marks its three lines; the marks of overlapping
windows merge, and marked lines go. Windows are judged on the input, and one without a word doesn't
count.

Only hashes and positions are shuffled to find repeats: partial aggregation leaves one row a window
and map task, and the join that looks for later occurrences can be split by AQE where one window is
in a third of all documents. Texts are shuffled once, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import without

WINDOW = 3
_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, body, pos, h1, h2) for each window with a word; body tells texts of one id apart."""
    hashed = df.select(
        F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(f"`{text}`").alias("body"),
        F.transform(_lines(F.col(f"`{text}`")), lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(_WORD).alias("word"))).alias("l"),
    ).where(F.size("l") >= WINDOW)
    at = lambda i, k: F.col("l")[i + k]
    return hashed.select("doc", "body", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("l") - WINDOW),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[at(i, k)["a"] for k in range(WINDOW)]).alias("h1"),
            F.xxhash64(*[at(i, k)["b"] for k in range(WINDOW)]).alias("h2"),
            (at(i, 0)["word"] | at(i, 1)["word"] | at(i, 2)["word"]).alias("word"))))).where("word").drop("word")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the kept lines as its text, plus n_lines and n_removed.

    Null and empty texts have no lines and stay as they are; texts of fewer than three lines have
    no window. Null ids come last in document order; different texts of one id, or without any, follow each
    other in the order of their hashes. Rows that agree in id and text are one place: neither counts as later
    than the other. Input columns named like a result give way to it.
    """
    kept = without(df, "n_lines", "n_removed")
    found = windows(kept, doc_id, text)
    place = F.struct(F.col("doc").isNull().alias("no_id"), F.col("doc"), F.col("body"), F.col("pos"))
    first = (found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where(F.col("first") < F.col("last")).drop("last"))
    later = found.join(first, ["h1", "h2"]).where(place > F.col("first"))
    marks = later.groupBy("doc", "body").agg(F.collect_set("pos").alias("__starts"))
    joined = kept.join(marks, kept[f"`{doc_id}`"].eqNullSafe(marks["doc"])
                       & (F.xxhash64(kept[f"`{text}`"]) == marks["body"]), "left").drop("doc", "body")
    body = F.col(f"`{text}`")
    lines = F.when(F.length(body) > 0, _lines(body)).otherwise(F.array().cast("array<string>"))
    joined = joined.withColumn("__lines", lines).withColumn("__covered", F.array_distinct(F.flatten(F.transform(
        F.coalesce("__starts", F.array().cast("array<int>")), lambda s: F.sequence(s, s + (WINDOW - 1))))))
    index = F.when(F.size("__lines") > 0, F.sequence(F.lit(0), F.size("__lines") - 1)).otherwise(F.array().cast("array<int>"))
    left = F.transform(F.array_except(index, F.col("__covered")), lambda i: F.col("__lines")[i])
    return joined.select(
        *[F.when(F.size("__covered") > 0, F.array_join(left, "\n")).otherwise(body).alias(c) if c == text else joined[f"`{c}`"]
          for c in kept.columns],
        F.size("__lines").cast("long").alias("n_lines"), F.size("__covered").cast("long").alias("n_removed"))
