"""Op 11: ranked lexical search, hybrid of term-at-a-time and document-at-a-time.

``build_index`` reads every text once and writes an inverted index: blocks of about ``BLOCK_BYTES`` of
consecutive documents, one row for each term of a block with its ordinals and counts, and one row
(term null) with the block's document ids and lengths. ``search`` sums the corpus statistics from the
index, moves only the lists of terms that some item asks for, and answers all items block by block:

* the item's short lists in the block are summed into accumulators, term at a time;
* the accumulators then are one more iterator with its own bound (their largest sum) beside the long
  lists, and documents are taken in order from the lists that can still lift a document over the
  20th best score so far; the others are only probed for documents whose bound still reaches it.

Skipping never changes the result: a document is left out only when its bound is below the score of
20 documents of its own block. A group is one block, so no task ever holds more than a block's lists.
The blocks' best documents are ranked per item in two steps, the first over salted groups.

Items are answered in parts of at most ``PART_BYTES`` of text (dealt by hash until each part fits, a
single larger item being a part of its own); only a part's terms, weights and item lists are broadcast.

Rows: a null or term-less text is no result and has no share in N. A null document id ranks after the
others among equal scores; rows that share an id are documents of their own. Rows of ``items`` that are
equal in id and text are one item, others are ranked each on its own; an item without terms, or
whose terms no document holds, has no rows. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.common import pieces
from pacewise.session import fresh_dir

TOP = 20                    # documents returned for an item
BLOCK_BYTES = 8 << 20       # text in one block of the index, one longer document being a block of its own
PART_BYTES = 4 << 20        # item texts answered by one pass over the index
SHORT = 16                  # a list of at most this part of a block's documents is short
RUN = 512                   # documents that one step of the document-at-a-time loop takes
SALTS = 256                 # groups of an item in the first ranking step
PIECE = 4 << 20             # bytes split into terms at a time

# Terms are runs of 0-9, A-Z (lower-cased), a-z and all bytes of non-ASCII characters.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else 0x20 for b in range(256))

INDEX = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("term", T.StringType()),
    T.StructField("docs", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    T.StructField("ids", T.ArrayType(T.LongType()))])
_INDEX = pa.schema([("block", pa.int64()), ("term", pa.string()), ("docs", pa.list_(pa.int32())),
                    ("counts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))])
HITS = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("salt", T.LongType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
_HITS = pa.schema([("item", pa.int32()), ("salt", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _bounded(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time; cuts fall on separators."""
    flat, start = data.translate(_TERM_BYTES), 0
    while start < len(flat):
        end = len(flat) if len(flat) - start <= PIECE else flat.find(b" ", start + PIECE)
        end = len(flat) if end < 0 else end
        yield flat[start:end].split()
        start = end


class _BlockWriter:
    """Collects documents and yields the index rows of each full block."""

    def __init__(self) -> None:
        self.number, self.task = 0, TaskContext.get().partitionId()
        self._clear()

    def _clear(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.names: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        self._open()

    def _open(self) -> None:
        self.terms: list[bytes] = []
        self.owners: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        n = 0
        for found in _bounded(data):
            self.terms += found
            self.owners.append((len(self.ids), len(found)))
            n += len(found)
            if len(self.terms) > 200_000:
                self._count()
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.size += len(data)

    def _count(self) -> None:
        """Terms so far to (term, ordinal) keys with counts."""
        if not self.terms:
            return
        coded = pa.array(self.terms, pa.binary()).dictionary_encode()
        names = np.array([self.names.setdefault(t, len(self.names)) for t in coded.dictionary.to_pylist()], np.int64)
        owner = np.repeat(np.array([o for o, _ in self.owners], np.int64), [n for _, n in self.owners])
        keys, counts = np.unique((names[np.asarray(coded.indices)] << 32) | owner, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self._open()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        self._count()
        block = (self.task << 32) | self.number
        self.number += 1
        yield pa.RecordBatch.from_pylist([{"block": block, "term": None, "docs": self.lengths, "counts": None, "ids": self.ids}], _INDEX)
        if self.keys:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))  # a long text is counted in pieces
            keys, counts = keys[start], np.add.reduceat(counts, start)
            term = keys >> 32
            edges = np.concatenate(([0], np.flatnonzero(term[1:] != term[:-1]) + 1, [len(term)])).astype(np.int32)
            names = pa.array(list(self.names), pa.binary()).cast(pa.string())
            docs, tfs = pa.array(keys & 0xFFFFFFFF).cast(pa.int32()), pa.array(counts).cast(pa.int32())
            n = len(edges) - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, block)), names, pa.ListArray.from_arrays(pa.array(edges), docs),
                pa.ListArray.from_arrays(pa.array(edges), tfs), pa.nulls(n, pa.list_(pa.int64()))], schema=_INDEX)
        self._clear()


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> None:
    """Writes the inverted index of ``docs`` at ``path``, a table of ``INDEX`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _BlockWriter()
        for batch in batches:
            for piece in pieces(batch, "body"):
                for doc_id, data in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    writer.add(doc_id, data or b"")
                    if writer.size >= block_bytes:
                        yield from writer.rows()
        yield from writer.rows()

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("body"))
    rows.mapInArrow(run, INDEX).write.parquet(path)


class _Block:
    """The lists of one block that the items of a part ask for, scored."""

    def __init__(self, table: pa.Table, weight: dict[str, tuple[int, int]], n_docs: int, n_terms: int) -> None:
        names = table.column("term").to_pylist()
        at = names.index(None)
        own = [i for i, t in enumerate(names) if t is not None]
        ids = table.column("ids").slice(at, 1).combine_chunks().flatten()
        self.none = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(np.iinfo(np.int64).max))
        length = np.asarray(table.column("docs").slice(at, 1).combine_chunks().flatten(), dtype=np.int64)
        norm = 100 - 25 + (25 * length * n_docs) // max(1, n_terms)
        lists = table.take(pa.array(own, pa.int64())).combine_chunks()
        rows = lists.column("docs").combine_chunks()
        sizes = np.asarray(rows.value_lengths(), dtype=np.int64)
        self.edges = np.concatenate(([0], np.cumsum(sizes)))
        self.docs = np.asarray(rows.flatten(), dtype=np.int64)
        tf = np.asarray(lists.column("counts").combine_chunks().flatten(), dtype=np.int64)
        known = [weight[names[i]] for i in own]
        self.place = {number: j for j, (number, _) in enumerate(known)}
        scale = np.repeat(np.array([w for _, w in known], np.int64), sizes)
        self.scores = scale * ((1_000_000_000 * tf) // (1000 * tf + 12 * norm[self.docs]))
        self.bounds = np.maximum.reduceat(self.scores, self.edges[:-1]) if own else np.zeros(0, np.int64)

    def iterators(self, asked: list[tuple[int, int]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(bound, ordinals, scores) of the summed short lists and of each long list, smallest bound first."""
        found, summed = [], None
        for number, times in asked:
            if (j := self.place.get(number)) is None:
                continue
            span = slice(self.edges[j], self.edges[j + 1])
            if (span.stop - span.start) * SHORT <= len(self.ids):
                summed = np.zeros(len(self.ids), np.int64) if summed is None else summed
                summed[self.docs[span]] += times * self.scores[span]
            else:
                found.append((times * int(self.bounds[j]), self.docs[span], times * self.scores[span]))
        if summed is not None:
            some = np.flatnonzero(summed)
            if some.size:
                found.append((int(summed.max()), some, summed[some]))
        return sorted((f for f in found if f[0]), key=lambda f: f[0])

    def best(self, asked: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and scores of the ``TOP`` best documents of the block."""
        its = self.iterators(asked)
        reach = np.concatenate(([0], np.cumsum([b for b, _, _ in its]))).astype(np.int64)
        top_docs, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, least = 0, 1
        while at < len(self.ids):
            weak = int(np.searchsorted(reach, least, side="left")) - 1  # so many lists together stay below
            heads = [(docs, scores, int(np.searchsorted(docs, at))) for _, docs, scores in its[weak:]]
            heads = [h for h in heads if h[2] < len(h[0])]
            if not heads:
                break
            at = min(int(docs[p]) for docs, _, p in heads)
            total = np.zeros(RUN, np.int64)
            for docs, scores, p in heads:
                end = int(np.searchsorted(docs, at + RUN))
                total[docs[p:end] - at] += scores[p:end]
            some = np.flatnonzero(total)
            for i in range(weak - 1, -1, -1):
                some = some[total[some] + reach[i + 1] >= least]
                if not some.size:
                    break
                _, docs, scores = its[i]
                p = np.searchsorted(docs, some + at)
                hit = docs[np.minimum(p, len(docs) - 1)] == some + at
                total[some[hit]] += scores[p[hit]]
            some = some[total[some] >= least]
            if some.size:
                top_docs = np.concatenate((top_docs, some + at))
                top_scores = np.concatenate((top_scores, total[some]))
                order = np.lexsort((self.ids[top_docs], self.none[top_docs], -top_scores))[:TOP]
                top_docs, top_scores = top_docs[order], top_scores[order]
                least = int(top_scores[-1]) if len(order) == TOP else 1
            at += RUN
        return top_docs, top_scores


def _ranked(spark: SparkSession, index: DataFrame, items: list[str], n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score, rank) for one part of the items, ``item`` being the place in ``items``."""
    asked = [Counter(t.decode("utf-8", "surrogatepass") for t in terms_of(text)) for text in items]
    wanted = sorted({t for terms in asked for t in terms})
    names = spark.createDataFrame(pa.table({"term": pa.array(wanted, pa.string())}))
    lists = index.where(F.col("term").isNotNull()).join(names, "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weights = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1))) for r in df.collect()}
    number = {t: i for i, t in enumerate(weights)}
    shared = spark.sparkContext.broadcast((
        {t: (number[t], w) for t, w in weights.items()},
        [[(number[t], k) for t, k in terms.items() if t in number] for terms in asked]))

    def run(table: pa.Table) -> pa.Table:
        weight, part = shared.value
        block = _Block(table, weight, n_docs, n_terms)
        salt = table.column("block")[0].as_py() % SALTS
        out = []
        for item, terms in enumerate(part):
            docs, scores = block.best(terms)
            if len(docs):
                ids = pa.array(block.ids[docs], mask=block.none[docs])
                out.append(pa.table([pa.array(np.full(len(docs), item, np.int32)), pa.array(np.full(len(docs), salt)), ids, pa.array(scores)], schema=_HITS))
        return pa.concat_tables(out) if out else _HITS.empty_table()

    rows = lists.select(*INDEX.names).unionByName(index.where(F.col("term").isNull()))
    hits = rows.groupBy("block").applyInArrow(run, HITS)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "salt"], ["item"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= TOP)
    return hits.drop("salt")


def _parts(items: DataFrame, count: int) -> DataFrame:
    return items.withColumn("part", F.pmod(F.xxhash64("item_id", "body"), F.lit(count)))


def search(spark: SparkSession, path: str, items: DataFrame, item_id: str = "item_id", text: str = "text",
           part_bytes: int = PART_BYTES) -> DataFrame:
    """The ``TOP`` best documents of the index at ``path`` for each item: item_id, rank, doc_id, score."""
    index = spark.read.schema(INDEX).parquet(path)
    size = index.where(F.col("term").isNull()).agg(
        F.sum(F.size(F.filter("docs", lambda n: n > 0))), F.sum(F.aggregate("docs", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    n_docs, n_terms = int(size[0] or 0), int(size[1] or 0)
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")).distinct()
    kept = fresh_dir(spark, "search-items")  # fixed rows: every part reads the same
    asked.write.parquet(kept)
    asked = spark.read.schema(asked.schema).parquet(kept)
    count, largest = 1, part_bytes + 1
    while largest > part_bytes:
        sizes = _parts(asked, count).groupBy("part").agg(F.sum(F.octet_length("body") + 64).alias("n"), F.count("*").alias("rows"))
        largest = sizes.where("rows > 1").agg(F.max("n")).first()[0] or 0
        count *= 1 if largest <= part_bytes else 2
    found = []
    for k in range(count):
        rows = _parts(asked, count).where(F.col("part") == k).select("item_id", "body").collect()
        if rows:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                          T.StructType([T.StructField("item", T.IntegerType()), asked.schema["item_id"]]))
            ranked = _ranked(spark, index, [r["body"] for r in rows], n_docs, n_terms)
            found.append(ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
            if count > 1:  # one plan for each part, not one of all parts
                made = fresh_dir(spark, "search-part")
                found[-1].write.parquet(made)
                found[-1] = spark.read.parquet(made)
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
