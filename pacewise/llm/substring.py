"""Op 4: removal of passages that repeat across documents, by fixed-block anchors.

A window is 13 consecutive words; a word goes if it is in a window whose words also start in a
document with a smaller id. Each document is cut into non-overlapping reference blocks of 7 words, so
every window holds a whole block of its document. Blocks are the index, and every rolling 7-word
window of every document probes it; a probe that meets a block of another place is an anchor. In
every document the windows that hold an anchor are extended to 13 words, and the smallest document
of each such window decides who keeps it; overlapping removed windows merge to maximal repeats.

Passes over packed chunks of documents (about a million words, compressed, checkpointed):
  1. distinct 7-word hashes of each chunk, cut to a width that grows with the corpus (a wrong match
     only makes one more candidate), dealt by hash range: one entry a chunk, however often a
     passage occurs in it; one bit for each comes back
  2. 96-bit hashes of the candidate windows and their smallest document in the chunk, dealt by hash
     range; one bit for each comes back: does a smaller document of another chunk have it
  3. covered words are removed
The number of ranges follows the number of words, so a task holds about ``RANGE_WORDS`` entries
at any size. Only hashes, bits and the packed chunks are shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import pieces, texts, without
from pacewise.llm.neardup import _Hashes, mix, word_hashes
from pacewise.session import checkpoint_root

WINDOW = 13
BLOCK = (WINDOW + 1) // 2       # a window holds a whole block wherever it starts
CHUNK_WORDS = 1 << 20
RANGE_WORDS = 1 << 21
NO_ID = np.iinfo(np.int64).max  # null ids come after all others
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Integer arrays by byte planes, compressed: sorted numbers are stored as their differences."""
    packed = []
    for x in arrays:
        packed.append((x.dtype.str, len(x), np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(packed))


def _unsqueezed(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
    return out


def _packed(docs: DataFrame) -> DataFrame:
    """(chunk, n_words, payload): ids and texts of some documents of one input partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, ids, bodies, size = TaskContext.get().partitionId() << 32, 0, [], [], 0
        pack = zstandard.ZstdCompressor(level=3)

        def chunk() -> pa.RecordBatch:
            payload = pack.compress(pickle.dumps((ids, bodies)))
            return pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                                              ["chunk", "n_words", "payload"])

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                for i, t in zip(piece.column(0).to_pylist(), texts(piece, "text"), strict=True):
                    raw = t.encode("utf-8", "surrogatepass")
                    ids.append(i)
                    bodies.append(raw)
                    size += len(raw.split())
                    if size >= CHUNK_WORDS:
                        yield chunk()
                        number, ids, bodies, size = number + 1, [], [], 0
        if ids:
            yield chunk()

    return docs.mapInArrow(run, "chunk bigint, n_words bigint, payload binary")


class _Chunk:
    """Documents of a chunk as one array of word hashes with their document numbers."""

    def __init__(self, payload: bytes, known: dict[bytes, int]) -> None:
        self.ids, self.bodies = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
        hashed = [word_hashes(b.split(), known) for b in self.bodies]
        self.words = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        self.ends = np.cumsum([len(h) for h in hashed])
        self.doc = np.repeat(np.arange(len(hashed)), [len(h) for h in hashed])
        self.order = np.array([NO_ID if i is None else i for i in self.ids], np.int64)

    def grams(self, size: int, step: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all runs of ``size`` words inside a document, and their hashes."""
        n = max(0, len(self.words) - size + 1)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = h * step + self.words[k: k + n]
        starts = np.flatnonzero(self.doc[:n] == self.doc[size - 1:])
        return starts, mix(h[starts])

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the probes; their distinct hashes in order, number of the hash of each, and flags of
        each hash: bit 0, it is a reference block; bit 1, it occurs twice or more in the chunk."""
        starts, h = self.grams(BLOCK, _STEP)
        values, number, count = np.unique(h >> np.uint64(64 - width), return_inverse=True, return_counts=True)
        flags = np.where(count > 1, 2, 0).astype(np.uint8)
        begins = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        aligned = (starts - begins[self.doc[starts]]) % BLOCK == 0
        flags[number[aligned]] |= 1
        return starts, values, number, flags

    def candidates(self, width: int, shared: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows that hold an anchor: starts, distinct (hash, check) in order, number of each
        window's, and the smallest document of each."""
        starts, _, number, _ = self.anchors(width)
        hit = np.zeros(len(self.words) + WINDOW, np.int32)
        hit[starts[shared[number]]] = 1
        held = np.concatenate(([0], np.cumsum(hit)))
        at, h = self.grams(WINDOW, _OTHER)
        yes = held[at + WINDOW - BLOCK + 1] > held[at]
        at, h = at[yes], h[yes]
        check = np.zeros(len(at), np.uint64)
        for k in range(WINDOW):
            check = (check ^ self.words[at + k]) * _STEP
        check = (check >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((check, h))
        h, check, docs = h[order], check[order], self.order[self.doc[at[order]]]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1]))) if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(new) - 1
        return at, h[first], check[first], number, np.minimum.reduceat(docs, first) if len(first) else docs


def _dealt(chunk: int, values: np.ndarray, width: int, ranges: int, *more: np.ndarray) -> pa.RecordBatch:
    """A row for each hash range that the chunk's sorted values reach."""
    cuts = _cuts(values, width, ranges)
    parts = [(k, _squeezed(np.diff(values[a:b], prepend=np.uint64(0)), *[x[a:b] for x in more]))
             for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int64()), pa.array([chunk] * len(parts), pa.int64()),
                                       pa.array([p for _, p in parts], pa.binary())], ["part", "chunk", "payload"])


def _cuts(values: np.ndarray, width: int, ranges: int) -> np.ndarray:
    """Where the sorted values of each of the hash ranges begin and end."""
    edges = [(k << width) // ranges for k in range(1, ranges)]
    return np.concatenate(([0], np.searchsorted(values, np.array(edges, np.uint64)), [len(values)]))


def _bits(rows: DataFrame) -> DataFrame:
    """(chunk, bits): the answers of all ranges for a chunk, in order of the range."""
    return rows.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("part", "n", "bits"))).alias("bits"))


def _joined_bits(bits: list | None) -> np.ndarray:
    if not bits:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(b["bits"], np.uint8), count=b["n"]).astype(bool) for b in bits])


_ANSWER = "part bigint, chunk bigint, n bigint, bits binary"


def _answers(table: pa.Table, sizes: list[int], flags: np.ndarray) -> pa.Table:
    cut = np.split(flags, np.cumsum(sizes)[:-1])
    return pa.table({"part": table["part"], "chunk": table["chunk"], "n": pa.array(sizes, pa.int64()),
                     "bits": pa.array([np.packbits(c).tobytes() for c in cut], pa.binary())})


def _shared_anchors(table: pa.Table) -> pa.Table:
    """For each hash of each chunk: is it a reference block somewhere and does it occur twice."""
    rows = [_unsqueezed(p) for p in table["payload"].to_pylist()]
    values = [np.cumsum(d) for d, _ in rows]
    v, flags = np.concatenate(values), np.concatenate([f for _, f in rows])
    order = np.argsort(v, kind="stable")
    s, f = v[order], flags[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    block = np.bitwise_or.reduceat(f, first) & 1
    twice = (np.diff(np.concatenate((first, [len(s)]))) > 1) | (np.bitwise_or.reduceat(f, first) & 2 > 0)
    yes = np.empty(len(v), bool)
    yes[order] = np.repeat((block > 0) & twice, np.diff(np.concatenate((first, [len(s)]))))
    return _answers(table, [len(x) for x in values], yes)


def _smaller_elsewhere(table: pa.Table) -> pa.Table:
    """For each window of each chunk: does a document smaller than all of the chunk's have it."""
    rows = [_unsqueezed(p) for p in table["payload"].to_pylist()]
    h, check = np.concatenate([np.cumsum(r[0]) for r in rows]), np.concatenate([r[1] for r in rows])
    doc = np.concatenate([r[2] for r in rows])
    order = np.lexsort((check, h))
    s, c = h[order], check[order]
    first = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (c[1:] != c[:-1]))))
    least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.concatenate((first, [len(s)]))))
    yes = np.empty(len(h), bool)
    yes[order] = least < doc[order]
    return _answers(table, [len(r[0]) for r in rows], yes)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): removed word spans (start, end; merged) and the kept
    words joined by one space.

    Ids are integers. Null texts have no words; a document of fewer than 13 words has no window. Null
    ids come after all others; rows of one id are no repeat of each other. Other columns are ignored.
    """
    checkpoint_root(df.sparkSession)
    kept = without(df, *[c for c in df.columns if c not in (doc_id, text)])
    chunks = _packed(kept.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))).checkpoint()
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_WORDS))
    width = min(60, max(32, total.bit_length() + 5))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                _, values, _, flags = _Chunk(payload.as_py(), known).anchors(width)
                yield _dealt(chunk, values, width, ranges, flags)

    dealt = "part bigint, chunk bigint, payload binary"
    shared = _bits(chunks.mapInArrow(probes, dealt).groupBy("part").applyInArrow(_shared_anchors, _ANSWER)).checkpoint()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for chunk, payload, bits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                _, h, check, _, doc = _Chunk(payload.as_py(), known).candidates(width, _joined_bits(bits.as_py()))
                yield _dealt(chunk, h, 64, ranges, check, doc)

    anchored = chunks.select("chunk", "payload").join(shared, "chunk", "left")
    smaller = _bits(anchored.mapInArrow(windows, dealt).groupBy("part").applyInArrow(_smaller_elsewhere, _ANSWER)).checkpoint()

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for payload, anchors, answers in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                c = _Chunk(payload.as_py(), known)
                at, _, _, number, doc = c.candidates(width, _joined_bits(anchors.as_py()))
                gone = _joined_bits(answers.as_py())[number] | (c.order[c.doc[at]] > doc[number])
                mark = np.zeros(len(c.words) + 1, np.int32)
                np.add.at(mark, at[gone], 1)
                np.add.at(mark, at[gone] + WINDOW, -1)
                covered = np.cumsum(mark)[:-1] > 0
                yield from _results(c, covered)

    both = anchored.join(smaller.withColumnRenamed("bits", "answers"), "chunk", "left").select("chunk", "payload", "bits", "answers")
    out = both.mapInArrow(removed, "doc bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept string")
    return out.withColumnRenamed("doc", doc_id)


def _results(c: _Chunk, covered: np.ndarray) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    begin, rows, size = 0, [], 0
    for i, body, end in zip(c.ids, c.bodies, c.ends.tolist(), strict=True):
        mine, words = covered[begin:end], body.split()
        n = int(mine.sum())
        spans = []
        if n:
            edge = np.diff(np.concatenate(([0], mine.view(np.int8), [0])))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            words = [w for w, x in zip(words, mine, strict=True) if not x]
        rows.append((i, end - begin, n, spans, b" ".join(words)))
        begin, size = end, size + len(body)
        if size > 8 << 20:
            yield _batch(rows, spans_type)
            rows, size = [], 0
    if rows:
        yield _batch(rows, spans_type)


def _batch(rows: list[tuple], spans_type: pa.DataType) -> pa.RecordBatch:
    doc, n, gone, spans, kept = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, spans_type),
                                       pa.array(kept, pa.binary()).cast(pa.string())], ["doc", "n_words", "n_removed", "spans", "kept"])
