"""Op 3: near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers are shingles of five consecutive words, labelled with their occurrence number. Each of
``SKETCHES`` sketches keeps the ``PICKS`` labelled shingles with the smallest hashes in their text order;
documents that agree in a sketch share a bucket. Two documents are near-duplicates if an
order-preserving alignment of their shingles matches ``c`` of ``n`` and ``m`` with c / (n + m - c) >= 0.8;
1 minus that ratio is a metric, the distance below.

Work is bounded in the size of groups of copies. Texts of equal words are one class before any bucket
is built. First, all members of a bucket are aligned with its hub only, the member that meets most
others: n near copies of one original cost n alignments. A member within 0.2 of the hub is linked; one
beyond 0.4 can't be near any linked member (triangle inequality). What that leaves open is decided
on the shingles themselves. Order a text's labelled shingles with those the hub lacks first. Near texts
share one among the first n - 0.8 n + 1, at places i and j with min(n - i, m - j) >= c for the c of
similarity 0.8, or they couldn't match c, and enough of those first ones (bounded by bit sets). So texts of one hub that share such a shingle form smaller
buckets; their members are compared with the bucket's own hub, then those of still different classes with
each other where the places allow it. Copies edited each in its own way fall apart there, as their own
edits come first, so they cost no alignment; no link inside a bucket is lost. Classes are the
connected components of the links, found by alternating large-star and small-star steps.

Two documents at similarity 0.8 agree in one of 32 sketches with probability 1 - (1 - 0.8**6)**32, over
0.9999; texts of up to 30 shingles use two picks instead of six. All state (sketches, buckets,
candidates' texts, links) is in checkpoints in the shared folder; nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.common import pieces, texts, without
from pacewise.session import checkpoint_root

SHINGLE = 5
SIMILAR = 0.8
SKETCHES, PICKS = 32, 6
SMALL_SKETCHES, SMALL_PICKS = 32, 2
SMALL_MOST, LARGE_LEAST = 30, 24     # shingles of texts with small and with large sketches
NEAR = 1 - SIMILAR
FAR = 2 * NEAR
_EPS = 1e-9
_WORD_CACHE = 400_000
BIT_WORDS = 16                       # of 64 bits, in a bound that texts of any length pass through
_MASK = (1 << 64) - 1


def _odd(k: int) -> int:
    return xxhash.xxh64_intdigest(b"order minhash", seed=k) | 1


_LARGE = np.array([_odd(k) for k in range(SKETCHES)], np.uint64)[:, None]
_SMALL = np.array([_odd(1000 + k) for k in range(SMALL_SKETCHES)], np.uint64)[:, None]
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """A hash for every five consecutive words; the whole text is one shingle if it has fewer."""
    h = word_hashes(words, known)
    size = min(SHINGLE, len(h))
    if not size:
        return h
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * _STEP + h[k: k + len(out)]
    return mix(out)


def labelled(h: np.ndarray) -> np.ndarray:
    """Shingle hashes mixed with their occurrence number, so that repeats are different k-mers."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = np.concatenate(([False], s[1:] == s[:-1]))
    if not same.any():
        return h
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
    out = np.empty_like(h)
    out[order] = mix(s + (np.arange(len(s)) - start).astype(np.uint64) * _STEP)
    return out


def _tuples(h: np.ndarray, factors: np.ndarray, picks: int, tag: int) -> np.ndarray:
    picks = min(picks, len(h))
    out = np.full(len(factors), tag, np.uint64)
    block = max(1, (1 << 18) // len(h))  # bounds the matrix of permuted hashes of a long text
    for at in range(0, len(factors), block):
        ranked = mix(h * factors[at: at + block]) if len(h) < 64 else h * factors[at: at + block]
        chosen = np.sort(np.argpartition(ranked, picks - 1, axis=1)[:, :picks], axis=1) if picks < len(h) else \
            np.broadcast_to(np.arange(picks), ranked.shape)
        key = out[at: at + block]
        for k in range(picks):
            key = mix(key * _STEP + h[chosen[:, k]])
        out[at: at + block] = key + np.arange(at, at + len(key), dtype=np.uint64)
    return out


def sketch(h: np.ndarray) -> np.ndarray:
    """Bucket keys of a text's shingle hashes."""
    if not len(h):
        return h
    h = labelled(h)
    found = []
    if len(h) <= SMALL_MOST:
        found.append(_tuples(h, _SMALL, SMALL_PICKS, 1))
    if len(h) >= LARGE_LEAST:
        found.append(_tuples(h, _LARGE, PICKS, 2))
    return np.unique(np.concatenate(found))


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence whose matches lie within ``band`` of the diagonal.

    Bit-parallel over a window of 2 * band + 1 columns that moves with the row.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low: len(a) - high], b[low: len(b) - high]
    n = len(a)
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    total, base, width = low + high, 0, min(n, band + 1)
    v = (1 << width) - 1                     # bit i: column base + i has no step yet
    for j, x in enumerate(b):
        start, end = max(0, j - band), min(n, j + band + 1)
        if end - base > width:
            v |= ((1 << (end - base)) - 1) ^ ((1 << width) - 1)
            width = end - base
        if start > base:
            gone = min(start - base, width)
            total += gone - (v & ((1 << gone) - 1)).bit_count()
            v >>= gone
            base, width = base + gone, width - gone
        if not width:
            break
        m = 0
        for i in where.get(x, ()):
            if base <= i < base + width and abs(i - j) <= band:
                m |= 1 << (i - base)
        u = v & m
        if u:
            v = ((v + u) | (v - u)) & ((1 << width) - 1)
    return total + width - v.bit_count()


def distance(a: list[int], b: list[int]) -> float:
    """1 - c / (n + m - c) for the aligned shingles, or 1.0 where that is beyond ``FAR``."""
    n, m = len(a), len(b)
    if not n or not m:
        return 1.0
    need = (1 - FAR) * (n + m) / (2 - FAR) - _EPS      # matches for a distance of FAR
    if min(n, m) < need or sum((Counter(a) & Counter(b)).values()) < need:
        return 1.0
    c = aligned(a, b, int(n + m - 2 * need) + 1)
    return 1 - c / (n + m - c) if c >= need else 1.0


_IDENTITY = ["none", "name", "h1", "h2"]


def _identity(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: the id, or that there is none, and 96 bits of the text."""
    body, name = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    return [name.isNull().alias("none"), F.coalesce(name.cast("string"), F.lit("")).alias("name"), F.xxhash64(body).alias("h1"), F.hash(body).alias("h2")]


def _sketched(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, body, n, keys, none, name, h1, h2): hash of the word sequence, number of shingles, bucket keys, ``_identity``."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"), *_identity(doc_id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for piece in pieces(batch, "text"):
                body, size, keys = [], [], []
                for t in texts(piece, "text"):
                    words = t.encode("utf-8", "surrogatepass").split()
                    h = shingle_hashes(words, known)
                    body.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                    size.append(len(h))
                    keys.append(sketch(h).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(body, pa.binary()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64())),
                     *piece.columns[2:]], ["doc", "body", "n", "keys", *_IDENTITY])

    return slim.mapInArrow(run, T.StructType([slim.schema["doc"], T.StructField("body", T.BinaryType()), T.StructField("n", T.IntegerType()),
                                              T.StructField("keys", T.ArrayType(T.LongType())), *[slim.schema[c] for c in _IDENTITY]]))


def rare_first(h: np.ndarray, hub: np.ndarray) -> np.ndarray:
    """The labelled shingles ``h`` of which any text near this one holds one, those outside ``hub`` first."""
    least = int(np.ceil(SIMILAR * len(h) - _EPS))
    return h[np.lexsort((h, np.isin(h, hub)))][: len(h) - least + 1]


def bit_set(h: np.ndarray) -> np.ndarray:
    """Words with a bit for every hash; each bit that two of them differ in is a hash only one has."""
    out = np.zeros(BIT_WORDS, np.uint64)
    np.bitwise_or.at(out, ((h >> np.uint64(6)) % np.uint64(BIT_WORDS)).astype(np.intp), np.uint64(1) << (h & np.uint64(63)))
    return out


def _compared(pairs: DataFrame, bodies: DataFrame, rare: bool = False) -> DataFrame:
    """(hub, doc) -> (hub, doc, n, d), with ``rare`` also the first shingles of ``rare_first`` and their bits.

    Both texts are joined in, which AQE can split for a hot hub.
    """
    both = pairs.join(bodies.select(F.col("doc").alias("hub"), F.col("text").alias("a")), "hub")
    both = both.join(bodies.select("doc", F.col("text").alias("b")), "doc").select("hub", "doc", "a", "b")
    names = ["hub", "doc", "n", "d", *(["rare", "bits", "all_bits"] if rare else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = _Hashes(), (None, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        for batch in batches:
            for piece in pieces(batch, "b"):
                sizes, out, first, bits, whole = [], [], [], [], []
                for a, b in zip(texts(piece, "a"), texts(piece, "b"), strict=True):
                    if last[0] != a:
                        h = shingle_hashes(a.encode("utf-8", "surrogatepass").split(), known)
                        last = (a, h, labelled(h))
                    h = shingle_hashes(b.encode("utf-8", "surrogatepass").split(), known)
                    sizes.append(len(h))
                    out.append(distance(last[1].tolist(), h.tolist()))
                    if rare:
                        h = labelled(h)
                        part = rare_first(h, last[2])
                        first.append(part.view(np.int64))
                        bits.append(bit_set(part).view(np.int64))
                        whole.append(bit_set(h).view(np.int64))
                columns = [piece.column(0), piece.column(1), pa.array(sizes, pa.int32()), pa.array(out, pa.float64())]
                if rare:
                    columns += [pa.array(x, pa.list_(pa.int64())) for x in (first, bits, whole)]
                yield pa.RecordBatch.from_arrays(columns, names)

    fields = [both.schema["hub"], both.schema["doc"], T.StructField("n", T.IntegerType()), T.StructField("d", T.DoubleType())]
    return both.mapInArrow(run, T.StructType(fields + [T.StructField(c, T.ArrayType(T.LongType())) for c in names[4:]]))


def _may_be_near(x: str, y: str) -> Column:
    """Whether rows x and y (n, i, first, bits, all_bits), which share a shingle at places i, can match enough.

    Three bounds on what they share: all of it lies from those places on; at most half of (both sizes less
    the bits that differ) is shared; and the longer rest at most is shared outside the ``first`` shingles of both.
    """
    need = SIMILAR / (1 + SIMILAR) * (F.col(f"{x}.n") + F.col(f"{y}.n")) - _EPS
    after = F.least(F.col(f"{x}.n") - F.col(f"{x}.i"), F.col(f"{y}.n") - F.col(f"{y}.i"))
    rest = F.greatest(F.col(f"{x}.n") - F.col(f"{x}.first"), F.col(f"{y}.n") - F.col(f"{y}.first"))

    def shared(size: str, bits: str) -> Column:
        differ = sum((F.bit_count(F.col(f"{x}.{bits}")[k].bitwiseXOR(F.col(f"{y}.{bits}")[k])) for k in range(BIT_WORDS)), F.lit(0))
        return (F.col(f"{x}.{size}") + F.col(f"{y}.{size}") - differ) / 2

    return (after >= need) & (shared("n", "all_bits") >= need) & (rest + shared("first", "bits") >= need)


def _roots(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    """(doc, root) of all linked documents for bucket rows (key, doc); see the module's text."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    order = rows.join(sizes, "key").groupBy("doc").agg((-F.sum("size")).alias("met")).checkpoint()
    rows = rows.join(order, "doc")
    hubs = rows.groupBy("key").agg(F.min(F.struct("met", "doc"))["doc"].alias("hub"))
    pairs = rows.join(hubs, "key").where("doc <> hub").select("hub", "doc").distinct()
    known = _compared(pairs, bodies, rare=True).checkpoint()
    links = known.where(F.col("d") <= NEAR + _EPS).select("doc", "hub")
    roots = components(links)

    # members that are near the hub and too far from any member of another class need no more
    told = _rooted(_rooted(known, roots, "doc", "root"), roots, "hub", "hub_root")
    other = told.where(F.col("root") != F.col("hub_root")).groupBy("hub").agg(F.min("d").alias("grey"))
    open_ = told.join(other, "hub").where((F.col("d") > NEAR + _EPS) | (F.col("d") >= F.col("grey") - NEAR - _EPS))
    open_ = open_.join(order, "doc").select("hub", "doc", "n", "root", "met", F.size("rare").alias("first"), "rare", "bits", "all_bits").checkpoint()
    parts = open_.select("hub", "doc", "root", F.posexplode("rare").alias("i", "shingle"))
    several = parts.groupBy("hub", "shingle").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("hub", "shingle")
    parts = parts.drop("root").join(several, ["hub", "shingle"], "left_semi").join(open_.drop("rare"), ["hub", "doc"]).checkpoint()
    if parts.isEmpty():
        return roots

    mids = parts.groupBy("hub", "shingle").agg(F.min(F.struct("met", "doc", "n", "i", "root", "first", "bits", "all_bits")).alias("mid")).select("hub", "shingle", "mid.*")
    x, y = mids.alias("x"), parts.alias("y")
    apart = F.col("x.root") != F.col("y.root")
    same = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.shingle") == F.col("y.shingle")) & apart & _may_be_near("x", "y")
    tried = x.join(y, same).select(F.least("x.doc", "y.doc").alias("hub"), F.greatest("x.doc", "y.doc").alias("doc")).distinct()
    tried = _compared(tried, bodies).checkpoint()
    found = tried.where(F.col("d") <= NEAR + _EPS).select("doc", "hub")
    if not found.isEmpty():
        links = links.unionByName(found)
        roots = components(links)
    x = _rooted(parts.drop("root"), roots, "doc", "root")
    x, y = x.alias("x"), x.alias("y")
    rest = x.join(y, same & (F.col("x.doc") < F.col("y.doc"))).select(F.col("x.doc").alias("hub"), F.col("y.doc").alias("doc")).distinct()
    rest = rest.join(tried.select("hub", "doc"), ["hub", "doc"], "left_anti")
    found = _compared(rest, bodies).where(F.col("d") <= NEAR + _EPS).select("doc", "hub").checkpoint()
    return roots if found.isEmpty() else components(links.unionByName(found))


def _rooted(rows: DataFrame, roots: DataFrame, of: str, name: str) -> DataFrame:
    """Adds the class so far of the documents in column ``of``."""
    found = roots.select(F.col("doc").alias(of), F.col("root").alias("__root"))
    return rows.join(found, of, "left").withColumn(name, F.coalesce("__root", F.col(of))).drop("__root")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows of buckets with two members or more."""
    several = rows.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("key")
    return rows.join(several, "key", "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """(doc, root): smallest member of the connected component of every node of ``edges`` (doc, hub)."""
    edges = edges.select(F.greatest("doc", "hub").alias("u"), F.least("doc", "hub").alias("v")).where("u > v").distinct().checkpoint()
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours point to the smallest one
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: smaller neighbours do
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u, v) belongs to one root v only."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("root"))
    return ends.groupBy("node").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").isEmpty()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id) for every row: the smallest id among its near-duplicates (its own if none).

    Texts without words (null, empty, white space) are near nothing; equal word sequences are one
    class at any length; texts under five words are near only those. Rows are compared by their own
    text: those that share an id with other texts, or have none, are linked like all others. Repeated rows
    stay. Null ids join a class but never name one (null if it has no other). Other columns are ignored.
    """
    checkpoint_root(df.sparkSession)
    docs = without(df, *[c for c in df.columns if c not in (doc_id, text)])
    rows = _sketched(docs, doc_id, text).checkpoint()
    # from here on a word sequence, numbered in a fixed table, is what is linked, not an id
    worded = rows.where("body is not null")
    classes = worded.groupBy("body").agg(F.min("doc").alias("least"), F.min(F.struct(*_IDENTITY)).alias("of"))
    classes = classes.select("body", "least", "of.*").withColumn("node", F.monotonically_increasing_id()).checkpoint()
    chosen = worded.select("body", "keys", *_IDENTITY).join(classes.drop("least"), ["body", *_IDENTITY])
    shared = _shared(chosen.select(F.explode("keys").alias("key"), F.col("node").alias("doc")).distinct()).checkpoint()
    wanted = classes.join(shared.select(F.col("doc").alias("node")).distinct(), "node", "left_semi").select("node", *_IDENTITY)
    found = docs.select(F.col(f"`{text}`").alias("text"), *_identity(doc_id, text)).where("text is not null")
    bodies = found.join(wanted, _IDENTITY).dropDuplicates(_IDENTITY).select(F.col("node").alias("doc"), "text").checkpoint()
    roots = _roots(shared, bodies)
    rooted = classes.select("body", "least", "node").join(roots.withColumnRenamed("doc", "node"), "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least").alias("rep"))
    named = rooted.join(names, "root").select("body", "rep")
    return rows.select("doc", "body").join(named, "body", "left").select(
        F.col("doc").alias(doc_id), F.when(F.col("body").isNull(), F.col("doc")).otherwise(F.col("rep")).alias("class_id"))
