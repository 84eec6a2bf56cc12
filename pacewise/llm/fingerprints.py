"""Op 13: document fingerprints from closed syncmers. Native: DataFrame functions only.

A text is cut into units (runs without ASCII white space, at most ``UNIT_CHARS`` code points each). A
window of ``K`` units is an anchor if the smallest of its inner windows of ``S`` units, by hash, is the first
or the last one (ties count). That depends on the window alone, so an unchanged stretch of text keeps
its anchors whatever surrounds it. The fingerprint is the sequence of the anchors' 32-bit hashes.

``likeness`` matches two fingerprints by position: the distinct anchors that both hold, each at its first
place, are paired; a pair counts if its shift (difference of places) is within ``SLACK`` of the median
shift; the result is twice the pairs over all distinct anchors, 0 to 1.

``with_next`` gives each row the head and the fingerprint of the row next in descending id, as a join of
slim rows: (id, text hash) is numbered by range partitions, only each partition's first row reaches the
driver, and the texts move once (the exchange is shared by both joins) plus the heads.

Rows: a null text is an empty one. An empty text (or white space alone) has an empty fingerprint, and
two empty fingerprints have likeness 1; a text of fewer than ``K`` units has one anchor for all of them.
Descending ids, nulls last; texts of one id follow each other by text hash. Rows equal in id and
text are one place in that order and get equal results, once per row. The last is followed by the
first, a single row by itself. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.session import fresh_dir

K = 7                # units of an anchor
S = 2                # units of an inner window
UNIT_CHARS = 16      # a longer run is cut into units of so many code points
SLACK = 64           # anchors by which a pair's shift may differ from the median shift

_INNER = K - S + 1
_UNIT = r"([^\x20\x09-\x0D]{1,%d})" % UNIT_CHARS


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not at each place where ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def fingerprint(text: Column) -> Column:
    """The anchors of a text in text order, as array<int>."""
    def anchors(h: Column, n: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), n - S), lambda i: F.hash(*[h[i + j] for j in range(S)]))

        def closed(v: Column) -> Column:
            def edge(i: Column) -> Column:
                least = F.least(*[v[i + j] for j in range(1, _INNER - 1)])
                return ((v[i] <= least) & (v[i] <= v[i + _INNER - 1])) | ((v[i + _INNER - 1] <= least) & (v[i + _INNER - 1] <= v[i]))
            return F.transform(F.filter(F.sequence(F.lit(0), n - K), edge), lambda i: F.hash(*[h[i + j] for j in range(K)]))
        return _let(inner, closed)

    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_UNIT), F.lit(1))
    none = F.array().cast("array<int>")
    return _let(F.transform(units, lambda w: F.hash(w)), lambda h: _let(F.size(h), lambda n: F.when(n == 0, none).when(
        n < K, F.array(F.hash(h))).otherwise(anchors(h, n))))


def likeness(a: Column, b: Column) -> Column:
    """Positional likeness of two fingerprints, 0 to 1."""
    def coded(prints: Column, side: int) -> Column:  # hash, side, place in one sortable number
        return F.transform(prints, lambda x, i: F.shiftleft(x.cast("long"), 32) + F.lit(side << 31) + i)

    def group(v: Column) -> Column:  # twice the hash, plus one on the second side
        return F.shiftright(v, 31)

    def matched(first: Column) -> Column:
        pair = F.filter(F.sequence(F.lit(0), F.size(first) - 2),
                        lambda t: (group(first[t]).bitwiseAND(F.lit(1)) == 0) & (group(first[t + 1]) == group(first[t]) + 1))
        shifts = F.array_sort(F.transform(pair, lambda t: first[t + 1] - first[t] - F.lit(1 << 31)))
        near = _let(shifts, lambda s: F.when(F.size(s) == 0, 0).otherwise(
            F.size(F.filter(s, lambda x: F.abs(x - s[F.floor(F.size(s) / 2).cast("int")]) <= SLACK))))
        return F.when(F.size(first) == 0, 1.0).when(F.size(first) == 1, 0.0).otherwise(2.0 * near / F.size(first))

    both = F.sort_array(F.concat(coded(a, 0), coded(b, 1)))
    return _let(both, lambda s: _let(
        F.filter(s, lambda v, t: (t == 0) | (group(v) != group(s[F.greatest(t - 1, F.lit(0))]))), matched))


_PLACE = ["none", "id", "hash"]


def _order() -> list[Column]:
    return [F.asc("none"), F.desc("id"), F.asc("hash")]


def _next_places(rows: DataFrame) -> DataFrame:
    """For each place its n_chars and the place after it (next_none, next_id, next_hash)."""
    spark = rows.sparkSession
    path = fresh_dir(spark, "fingerprint-places")  # range partitions are drawn anew whenever they are computed
    slim = rows.groupBy(*_PLACE).agg(F.max("n_chars").alias("n_chars"))
    slim.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *_order()).withColumn(
        "part", F.spark_partition_id()).write.parquet(path)
    part = Window.partitionBy("part").orderBy(*_order())
    slim = spark.read.schema(T.StructType([*slim.schema.fields, T.StructField("part", T.IntegerType())])).parquet(path)
    slim = slim.select("*", F.lead(F.struct(*_PLACE)).over(part).alias("next"), F.row_number().over(part).alias("row"))
    first = {r["part"]: tuple(r["place"]) for r in slim.where("row = 1").select("part", F.struct(*_PLACE).alias("place")).collect()}
    parts = sorted(first)  # one row for each range partition, of which the session sets the number
    after = [(p, first[q]) for p, q in zip(parts, [*parts[1:], *parts[:1]], strict=True)]
    after = spark.createDataFrame(after, T.StructType([T.StructField("part", T.IntegerType()), T.StructField("after", slim.schema["next"].dataType)]))
    found = slim.join(F.broadcast(after), "part").withColumn("next", F.coalesce("next", "after"))
    return found.select(*_PLACE, "n_chars", *[F.col("next")[c].alias(f"next_{c}") for c in _PLACE])


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, body, n_chars, fingerprint, next_fingerprint and head (first n_chars // 3 code points of the next text)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").isNull().alias("none"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(body).alias("hash"), body.alias("body"))
    places = _next_places(rows.withColumn("n_chars", F.length("body").cast("long")))
    printed = rows.withColumn("fingerprint", fingerprint(F.col("body")))
    wanted = places.select(*[F.col(c).alias(f"own_{c}") for c in _PLACE], F.col("n_chars").alias("own_chars"),
                           *[F.col(f"next_{c}").alias(c) for c in _PLACE])
    lent = printed.join(wanted, _PLACE).select(
        *[F.col(f"own_{c}").alias(c) for c in _PLACE], F.col("own_chars").alias("n_chars"),
        F.substring("body", F.lit(1), F.floor(F.col("own_chars") / 3).cast("int")).alias("head"), F.col("fingerprint").alias("next_fingerprint"))
    lent = lent.dropDuplicates(_PLACE)  # the next place may hold equal rows
    return printed.join(lent, _PLACE).select(F.when(~F.col("none"), F.col("id")).alias(key), "body", "n_chars", "fingerprint",
                                             "next_fingerprint", "head")


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``with_next`` plus edited (the last third replaced by the head), edited_fingerprint, near_edited, near_next."""
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")
    rows = with_next(docs, key, text).withColumn("edited", F.concat(F.substring("body", F.lit(1), keep), "head"))
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).withColumn(
        "near_next", likeness(F.col("fingerprint"), F.col("next_fingerprint")))


def as_text(prints: Column) -> Column:
    """A fingerprint as a string: its anchors in hex, in order."""
    return F.array_join(F.transform(prints, lambda x: F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), " ")
