"""Op 12: alignment of two tokenizers over the same bytes, by an associative fragment monoid.

Texts are encoded with a byte-level BPE (A, a space put before the text) and a sentencepiece model (B, which
puts that space itself). Byte offsets where both end a token cut the tokens into groups; an A and a B
token whose byte ranges overlap are linked.

A text of at most ``CHUNK`` bytes is one piece of work. A longer one is dealt out as byte-range chunks, each
encoded in a window that reaches to the next safe cuts (a space between a printable character and a
letter, which no token of either side crosses), so that a chunk owns the tokens that end in its range,
wherever the range falls. A chunk yields a ``Fragment``: an open prefix up to its first common cut, closed
groups, an open suffix. Composition of neighbours is associative: suffix and prefix between two cuts
close into one more group, a fragment without any cut is open as a whole. Spark composes ``FAN`` neighbours
a task and level until one fragment is left for each text; closed groups stay where they were made, only
the open ends move. The digest of a long text's groups is taken from its sorted pieces as a stream.

Corpus-wide pair counts: each block of about ``BLOCK`` bytes of text writes its distinct pairs once and, for
each text, places in that list. The pairs (at most one row for each pair and block) are counted and the
highest count of each B id, at most one row for each id of the vocabulary, is broadcast. The counts go
back to their block, where they are summed per text.

Rows: texts that are null, empty or not reproduced byte for byte by both tokenizers have no tokens, zeros
and the groups ''. Ids may be null or repeated, each row is a text of its own. Other columns of the input
are not looked at. A stretch without any safe cut within ``CHUNK / 4`` of a range's end joins two ranges
to one, which one task encodes: no library can split that.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pacewise.llm.common import pieces
from pacewise.session import fresh_dir

CHUNK = 64 << 10      # bytes of a chunk; a longer text is dealt out
BLOCK = 16 << 20      # text that shares one list of pairs
FAN = 16              # neighbours composed by one task of a level
PIECE = 2 << 20       # text encoded at a time
KEPT = 64 << 20       # bytes that stretches and their ids may take in a worker; then it starts anew
JOINED = 32 << 10     # bytes of new stretches encoded in one call

# Letters of two bytes before and after the space of a safe cut: Latin to U+024F, Cyrillic to U+047F.
_LETTER = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f]|[\xd0\xd1][\x80-\xbf]"
_BEFORE = rb"[!-~]|[\xc3-\xc8\xd0\xd1][\x80-\xbf]"
_SAFE = re.compile(rb" (?=[A-Za-z]|" + _LETTER + rb")(?:(?<=[!-~] )|(?<=[\xc3-\xc8\xd0\xd1][\x80-\xbf] ))")
_INNER = re.compile(rb"(?=[A-Za-z]|" + _LETTER + rb").*(?:" + _BEFORE + rb")", re.DOTALL)  # may stand between two safe cuts


@functools.cache
def _byte_of() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones as they are, the rest from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers with the bytes, byte lengths and decimal names of their tokens."""

    def __init__(self, a_json: str, b_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=b_model)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(_byte_of()[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size()))]
        self.width = len(self.b_bytes)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id's decimal digits with what follows it: "," inside a side, "|" after the last A, ";" after the last B
        self.words = np.array([f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"]
                              + [f"{i}{c}" for i in range(self.width) for c in ",;"], object)

        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.kept = 0
        self.same = np.zeros(0, bool)
        self.a_ids, self.b_ids = Lists(), Lists()

    def _whole(self, texts: list[bytes]) -> list[tuple[list[int], list[int], bool]]:
        """Ids of both for each text (a space before it), and whether both give its bytes back."""
        plain = [t.decode() for t in texts]
        a = [e.ids for e in self.a.encode_batch([" " + t for t in plain], add_special_tokens=False)]
        b = self.b.encode(plain, num_threads=1)
        return [(x, y, b"".join(map(self.a_bytes.__getitem__, x)) == b" " + t == b"".join(map(self.b_bytes.__getitem__, y)))
                for t, x, y in zip(texts, a, b, strict=True)]

    def _learn(self, new: list[bytes]) -> None:
        """Ids of new stretches: those that may stand between safe cuts are joined to longer texts and cut again."""
        inner, alone, size = [[]], [], 0
        for t in new:
            if _INNER.fullmatch(t):
                if size + len(t) > JOINED and inner[-1]:
                    inner.append([])
                    size = 0
                inner[-1].append(t)
                size += len(t) + 1
            else:
                alone.append(t)
        inner = [x for x in inner if x]
        for group, (a, b, same) in zip(inner, self._whole([b" ".join(x) for x in inner]), strict=True):
            ends = np.cumsum([len(t) + 1 for t in group])
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            if same and np.isin(ends, a_end).all() and np.isin(ends, b_end).all():
                self._keep(group, a, np.searchsorted(a_end, ends) + 1, b, np.searchsorted(b_end, ends) + 1, np.ones(len(group), bool))
            else:
                alone += group
        made = self._whole(alone)
        self._keep(alone, list(chain.from_iterable(x for x, _, _ in made)), np.cumsum([len(x) for x, _, _ in made], dtype=np.int64),
                   list(chain.from_iterable(y for _, y, _ in made)), np.cumsum([len(y) for _, y, _ in made], dtype=np.int64),
                   np.array([s for _, _, s in made], bool))

    def _keep(self, group: list[bytes], a: list[int], a_stop: np.ndarray, b: list[int], b_stop: np.ndarray, same: np.ndarray) -> None:
        for t in group:
            self.places[t] = len(self.places)
            self.kept += len(t) + 160  # with the dictionary's entry and some ids
        self.a_ids.extend(a, a_stop)
        self.b_ids.extend(b, b_stop)
        self.same = np.concatenate((self.same, same))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts of at least one byte (without their space): whether both give the bytes back, the A ids of all
        texts and how many each has, and the same for B.

        Stretches between safe cuts are encoded on their own, so one that was seen before keeps its ids.
        """
        if self.kept > KEPT:
            self._forget()
        split = [_SAFE.split(t) for t in texts]
        flat = list(chain.from_iterable(split))
        if new := list(dict.fromkeys(t for t in flat if t not in self.places)):
            self._learn(new)
        place = np.fromiter(map(self.places.__getitem__, flat), np.int64, len(flat))
        first = np.cumsum([0, *(len(x) for x in split)])[:-1]
        a, n_a = self.a_ids.take(place)
        b, n_b = self.b_ids.take(place)
        return np.logical_and.reduceat(self.same[place], first), a, np.add.reduceat(n_a, first), b, np.add.reduceat(n_b, first)


class Lists:
    """Growing lists of ids, one array with the places where they stop."""

    def __init__(self) -> None:
        self.ids, self.stops = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def extend(self, ids: list[int], stops: np.ndarray) -> None:
        self.stops = np.concatenate((self.stops, stops + len(self.ids)))
        self.ids = np.concatenate((self.ids, np.array(ids, np.int32)))

    def take(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at ``place`` after each other, and their lengths."""
        start = self.stops[place]
        sizes = self.stops[place + 1] - start
        skip = np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
        return self.ids[skip + np.arange(len(skip))].astype(np.int64), sizes


@functools.lru_cache(maxsize=1)
def _load(a_json: str, b_model: bytes) -> Pair:
    return Pair(a_json, b_model)


def _pair(shared: Broadcast) -> Pair:
    """The tokenizers of a broadcast, built once a worker."""
    return _load(*shared.value)


class Aligned:
    """Groups and links of token sequences that start and end at common cuts."""

    def __init__(self, pair: Pair, a: np.ndarray, b: np.ndarray) -> None:
        self.pair, self.a, self.b = pair, a, b
        self.a_end, self.b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        self.b_at = np.searchsorted(self.b_end, self.a_end)  # the B token in which each A token ends
        self.a_last = self.b_end[self.b_at] == self.a_end if len(b) else np.zeros(0, bool)
        self.b_last = np.zeros(len(b), bool)
        self.b_last[self.b_at[self.a_last]] = True

    @property
    def cuts(self) -> np.ndarray:
        return self.a_end[self.a_last]

    def words(self) -> np.ndarray:
        """The groups as words in order: all A ids of a group, then its B ids."""
        a_group, b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        b_stop, a_stop = np.flatnonzero(self.b_last) + 1, np.flatnonzero(self.a_last) + 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.concatenate(([0], b_stop))[a_group]] = 2 * self.a + self.a_last
        codes[np.arange(len(self.b)) + a_stop[b_group]] = 2 * (self.b + len(self.pair.a_bytes)) + self.b_last
        return self.pair.words[codes]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each link's pair as a * width + b, and the place of its A token: one for every stretch between two ends."""
        lone = np.flatnonzero(~self.b_last)
        a_at = np.searchsorted(self.a_end, self.b_end[lone])
        pairs = np.concatenate((self.a * self.pair.width + self.b[self.b_at], self.a[a_at] * self.pair.width + self.b[lone]))
        return pairs, np.concatenate((np.arange(len(self.a)), a_at))


# --- blocks: distinct pairs once, places in that list for each text ---------------------------------
PACKED = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("pair", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType())])
_PACKED = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("pair", pa.int64()), ("n", pa.int64()), ("key", pa.int64()),
                     ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("groups", pa.string()), ("links", pa.binary())])


def _squeeze(rising: np.ndarray, times: np.ndarray) -> bytes:
    flat = np.concatenate((np.diff(rising, prepend=0), times)).astype("<u4")
    return zstandard.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(flat[:len(flat) // 2]), flat[len(flat) // 2:]


class _Packer:
    """Collects rows with their links and yields a block's rows when it is full."""

    def __init__(self, first: int) -> None:
        self.next = first + (TaskContext.get().partitionId() << 32)
        self._clear()

    def _clear(self) -> None:
        self.rows: list[dict] = []
        self.owners: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: list[dict], owner: np.ndarray, pairs: np.ndarray, size: int) -> None:
        """``owner`` is the place in ``rows`` of each link."""
        base = int(pairs.max()) + 1 if len(pairs) else 1
        both, times = np.unique(owner * base + pairs, return_counts=True)
        self.owners.append(both // base + len(self.rows))
        self.pairs.append(both % base)
        self.times.append(times)
        self.rows += rows
        self.size += size

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """The block's rows, if it holds any and has ``least`` bytes."""
        if not self.rows or self.size < least:
            return
        owner, pairs, times = (np.concatenate(x) for x in (self.owners, self.pairs, self.times))
        kinds, place = np.unique(pairs, return_inverse=True)
        total = np.bincount(place, weights=times, minlength=len(kinds)).astype(np.int64)
        order = np.argsort(-total, kind="stable")  # frequent pairs first: small numbers
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[place]
        sort = np.lexsort((place, owner))
        owner, place, times = owner[sort], place[sort], times[sort]
        edges = np.searchsorted(owner, np.arange(len(self.rows) + 1))
        for i, row in enumerate(self.rows):
            lo, hi = edges[i], edges[i + 1]
            row |= {"block": self.next, "links": _squeeze(place[lo:hi], times[lo:hi]) if hi > lo else None}
        for i in range(0, len(self.rows), 10_000):
            yield pa.RecordBatch.from_pylist(self.rows[i:i + 10_000], _PACKED)
        n = len(kinds)
        if n:
            lists = {"block": pa.array(np.full(n, self.next)), "place": pa.array(np.arange(n, dtype=np.int32)),
                     "pair": pa.array(kinds[order]), "n": pa.array(total[order])}
            yield pa.RecordBatch.from_arrays([lists.get(f.name, pa.nulls(n, f.type)) for f in _PACKED], schema=_PACKED)
        self.next += 1
        self._clear()


def _short_rows(pair: Pair, ids: list, bodies: list[str], whole: bool) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Rows, link owners and pairs of texts that are encoded whole."""
    rows = [{"doc_id": d, "n_a": 0, "n_b": 0, "n_groups": 0, "groups": ""} for d in ids]
    some = [i for i, t in enumerate(bodies) if t]
    if not some:
        return rows, np.zeros(0, np.int64), np.zeros(0, np.int64)
    same, a, n_a, b, n_b = pair.encode([bodies[i].encode() for i in some])
    if not same.all():
        a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
        n_a, n_b, some = n_a[same], n_b[same], [i for i, s in zip(some, same, strict=True) if s]
        if not some:
            return rows, np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = Aligned(pair, a, b)
    words = both.words().tolist()
    a_stop, stop = np.cumsum(n_a), np.cumsum(n_a + n_b)
    n_groups = np.diff(np.concatenate(([0], np.cumsum(both.a_last)[a_stop - 1])))
    for k, i in enumerate(some):
        text = "".join(words[stop[k] - n_a[k] - n_b[k]:stop[k]])[:-1]
        rows[i] |= {"n_a": int(n_a[k]), "n_b": int(n_b[k]), "n_groups": int(n_groups[k]),
                    "groups": text if whole else hashlib.sha256(text.encode()).hexdigest()}
    pairs, a_at = both.links()
    return rows, np.array(some)[np.searchsorted(a_stop, a_at, side="right")], pairs


# --- long texts: chunks, fragments, composition ----------------------------------------------------
CHUNKS = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("chunk", T.LongType()),
    T.StructField("body", T.StringType()), T.StructField("skip", T.LongType()), T.StructField("stop", T.LongType())])
_OPEN = [("pre_a", pa.binary()), ("pre_b", pa.binary()), ("cut", pa.bool_()), ("first", pa.int64()), ("suf_a", pa.binary()), ("suf_b", pa.binary())]
_OPEN_SPARK = [T.StructField("pre_a", T.BinaryType()), T.StructField("pre_b", T.BinaryType()), T.StructField("cut", T.BooleanType()),
               T.StructField("first", T.LongType()), T.StructField("suf_a", T.BinaryType()), T.StructField("suf_b", T.BinaryType())]
FRAGMENTS = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("chunk", T.LongType()),
    T.StructField("same", T.BooleanType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("groups", T.StringType()), T.StructField("pairs", T.BinaryType()), *_OPEN_SPARK])
_FRAGMENTS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("same", pa.bool_()), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()), ("pairs", pa.binary()), *_OPEN])
LEVEL = T.StructType([T.StructField("key", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("seam", T.BooleanType()), *_OPEN_SPARK])
_LEVEL = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("seam", pa.bool_()), *_OPEN])


def chunks_of(data: bytes, size: int) -> Iterator[tuple[bytes, int, int]]:
    """(window, skip, stop) for each byte range of ``data`` (its space included): the window runs from a safe cut
    to a safe cut, and the range owns the tokens whose end in the window is over ``skip`` and at most ``stop``."""
    edges, reach = [(0, 0, 0)], size // 4
    for at in range(size, len(data) - reach, size):
        # one byte more on each side than the cut itself, for what must stand around it
        before = [m.start() for m in _SAFE.finditer(data, max(0, at - reach), min(len(data), at + 4)) if m.start() <= at]
        after = _SAFE.search(data, at, min(len(data), at + reach))
        if before and after:
            edges.append((at, before[-1], after.start()))
    edges.append((len(data), len(data), len(data)))
    for (lo, start, _), (hi, _, end) in zip(edges, edges[1:]):
        yield data[start:end], lo - start, hi - start


@dataclass
class Fragment:
    """Tokens of a stretch: up to its first common cut, and after its last one; all in ``prefix`` if it has none."""

    prefix: tuple[np.ndarray, np.ndarray]
    cut: bool = False
    first: int = -1     # chunk that holds the first cut
    suffix: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def then(self, other: Fragment) -> tuple[Fragment, tuple[int, tuple[np.ndarray, np.ndarray]] | None]:
        """This stretch followed by ``other``, and the group that closes between two cuts, with its chunk."""
        tail = self.suffix if self.cut else self.prefix
        joined = (np.concatenate((tail[0], other.prefix[0])), np.concatenate((tail[1], other.prefix[1])))
        if not self.cut:
            return Fragment(joined, other.cut, other.first, other.suffix), None
        if not other.cut:
            return Fragment(self.prefix, True, self.first, joined), None
        closed = (other.first, joined) if len(joined[0]) else None
        return Fragment(self.prefix, True, self.first, other.suffix), closed

    def columns(self) -> dict:
        pack = lambda x: x.astype("<u4").tobytes()
        return {"pre_a": pack(self.prefix[0]), "pre_b": pack(self.prefix[1]), "cut": self.cut, "first": self.first,
                "suf_a": pack(self.suffix[0]), "suf_b": pack(self.suffix[1])}

    @staticmethod
    def read(row: dict) -> Fragment:
        ids = lambda c: np.frombuffer(row[c], "<u4").astype(np.int64)
        return Fragment((ids("pre_a"), ids("pre_b")), row["cut"], row["first"], (ids("suf_a"), ids("suf_b")))


def fragment(pair: Pair, x: np.ndarray, y: np.ndarray, skip: int, stop: int, chunk: int) -> tuple[Fragment, Aligned | None, int, int]:
    """The fragment of a range, its closed groups, and how many A and B tokens it owns."""
    x_end, y_end = np.cumsum(pair.a_size[x]), np.cumsum(pair.b_size[y])
    own_x, own_y = (x_end > skip) & (x_end <= stop), (y_end > skip) & (y_end <= stop)
    x, x_end, y, y_end = x[own_x], x_end[own_x], y[own_y], y_end[own_y]
    cuts = np.intersect1d(x_end, y_end, assume_unique=True)
    if not len(cuts):
        return Fragment((x, y)), None, len(x), len(y)
    split = lambda end: np.searchsorted(end, [cuts[0], cuts[-1]], side="right")
    (i, j), (k, m) = split(x_end), split(y_end)
    closed = Aligned(pair, x[i:j], y[k:m]) if j > i else None
    return Fragment((x[:i], y[:k]), True, chunk, (x[j:], y[m:])), closed, len(x), len(y)


def _split_long(df: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for k, (window, skip, stop) in enumerate(chunks_of(b" " + row["body"].encode(), size)):
                    yield pa.RecordBatch.from_pylist([{"key": row["key"], "doc_id": row["doc_id"], "chunk": k, "body": window[1:].decode(),
                                                       "skip": skip, "stop": stop}], _CHUNKS)
    return df.mapInArrow(run, CHUNKS)


_CHUNKS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("body", pa.string()), ("skip", pa.int64()), ("stop", pa.int64())])


def _fragments(df: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(shared)
        for batch in batches:
            for piece in pieces(batch, "body", PIECE):
                rows, out = piece.to_pylist(), []
                same, a, a_n, b, b_n = pair.encode([r["body"].encode() for r in rows])
                a_stop, b_stop = np.cumsum(a_n), np.cumsum(b_n)
                for k, row in enumerate(rows):
                    made = {"key": row["key"], "doc_id": row["doc_id"], "chunk": row["chunk"], "same": bool(same[k])}
                    if same[k]:
                        ids = a[a_stop[k] - a_n[k]:a_stop[k]], b[b_stop[k] - b_n[k]:b_stop[k]]
                        part, closed, n_a, n_b = fragment(pair, *ids, row["skip"], row["stop"], row["chunk"])
                        made |= part.columns() | {"n_a": n_a, "n_b": n_b, "n_groups": len(closed.cuts) if closed else 0,
                                                  "groups": "".join(closed.words().tolist()) if closed else "",
                                                  "pairs": closed.links()[0].astype("<i8").tobytes() if closed else b""}
                    out.append(made)
                yield pa.RecordBatch.from_pylist(out, _FRAGMENTS)
    return df.mapInArrow(run, FRAGMENTS)


def _compose(table: pa.Table) -> pa.Table:
    """The fragments of one group of neighbours as one fragment, and the groups closed between them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    out, whole = [], Fragment.read(rows[0])
    for row in rows[1:]:
        whole, closed = whole.then(Fragment.read(row))
        if closed:
            out.append(Fragment(closed[1], True, closed[0]).columns() | {"key": row["key"], "chunk": closed[0], "seam": True})
    out.append(whole.columns() | {"key": rows[0]["key"], "chunk": rows[0]["chunk"] // FAN, "seam": False})
    return pa.Table.from_pylist(out, _LEVEL)


def _seams(good: DataFrame) -> DataFrame:
    """The groups that close across chunks, from a tree of compositions: key, chunk before whose groups it stands, ids."""
    spark = good.sparkSession
    level = good.select("key", "chunk", F.lit(False).alias("seam"), *[f.name for f in _OPEN_SPARK])
    chunks = (good.agg(F.max("chunk")).first()[0] or 0) + 1
    seams = None
    while True:
        path = fresh_dir(spark, "alignment-level")
        level.groupBy("key", F.floor(F.col("chunk") / FAN).alias("parent")).applyInArrow(_compose, LEVEL).write.parquet(path)
        made = spark.read.schema(LEVEL).parquet(path)
        closed = made.where("seam")
        seams = closed if seams is None else seams.unionByName(closed)
        level, chunks = made.where("not seam"), -(-chunks // FAN)
        if chunks <= 1:
            break
    # a text starts at a cut, so what is open before its first cut is a group; nothing is open after its end
    start = level.where(F.octet_length("pre_a") > 0).withColumn("chunk", F.col("first"))
    return seams.unionByName(start).select("key", "chunk", "pre_a", "pre_b")


def _seam_rows(seams: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(shared)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                one = Aligned(pair, *[np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("pre_a", "pre_b")])
                out.append({"key": row["key"], "chunk": row["chunk"], "part": 0, "groups": "".join(one.words().tolist()),
                            "n_groups": len(one.cuts), "pairs": one.links()[0].astype("<i8").tobytes()})
            yield pa.RecordBatch.from_pylist(out, _PARTS)
    return seams.mapInArrow(run, PARTS)


PARTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()),
                      T.StructField("groups", T.StringType()), T.StructField("n_groups", T.LongType()), T.StructField("pairs", T.BinaryType())])
_PARTS = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("part", pa.int32()), ("groups", pa.string()), ("n_groups", pa.int64()), ("pairs", pa.binary())])


def _streamed(parts: DataFrame, whole: bool) -> DataFrame:
    """key and groups (digest or text) of each long text, from its parts in order."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("groups", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, some, texts = None, hashlib.sha256(), False, []

        def done() -> pa.RecordBatch:
            said = ";".join(texts) if whole else held.hexdigest()
            return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int64()), "groups": [said]})

        for batch in batches:
            for row_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if row_key != key:
                    if key is not None:
                        yield done()
                    key, held, some, texts = row_key, hashlib.sha256(), False, []
                if text:
                    if whole:
                        texts.append(text[:-1])
                    else:
                        held.update(((";" if some else "") + text[:-1]).encode())
                    some = True
        if key is not None:
            yield done()

    ordered = parts.repartition(F.col("key")).sortWithinPartitions("key", "chunk", "part")
    return ordered.select("key", "groups").mapInArrow(run, schema)


def _long_texts(docs: DataFrame, shared: Broadcast, size: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """(packed links, one row for each long text)"""
    spark = docs.sparkSession
    keyed = docs.withColumn("key", F.monotonically_increasing_id()).where(F.octet_length("body") > size)
    path = fresh_dir(spark, "alignment-fragments")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _fragments(_split_long(keyed.select("key", "doc_id", "body"), size).repartition(parts, "key", "chunk"), shared).write.parquet(path)
    made = spark.read.schema(FRAGMENTS).parquet(path)
    good = made.join(made.where("not same").select("key").distinct(), "key", "left_anti")
    seam_path = fresh_dir(spark, "alignment-seams")
    _seam_rows(_seams(good), shared).write.parquet(seam_path)
    seams = spark.read.schema(PARTS).parquet(seam_path)
    closed = good.select("key", "chunk", F.lit(1).alias("part"), "groups", "n_groups", "pairs")
    pieces_ = closed.unionByName(seams)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(1 << 60)
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["pairs"], "<i8")
                packer.add([{"key": row["key"]}], np.zeros(len(pairs), np.int64), pairs, len(pairs) * 2)
                yield from packer.flush(BLOCK)
        yield from packer.flush()

    links = pieces_.where(F.octet_length("pairs") > 0).select("key", "pairs").mapInArrow(pack, PACKED)
    counts = good.groupBy("key").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    groups = pieces_.groupBy("key").agg(F.sum("n_groups").alias("n_groups"))
    summary = counts.join(groups, "key").join(_streamed(pieces_.select("key", "chunk", "part", "groups"), whole), "key")
    every = made.where("chunk = 0").select("key", "doc_id").join(summary, "key", "left")
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("n_a", "n_b", "n_groups")}
    return links, every.withColumns(zeros | {"groups": F.coalesce("groups", F.lit(""))})


SUMS = T.StructType([*[f for f in PACKED.fields if f.name in ("key", "doc_id", "n_a", "n_b", "n_groups", "groups")],
                     T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
_SUMS = pa.schema([*[f for f in _PACKED if f.name in ("key", "doc_id", "n_a", "n_b", "n_groups", "groups")],
                   ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _sums(rows: pa.Table, marks: pa.Table) -> pa.Table:
    """The rows of one block with the counts of their links; ``mark`` is twice the count, plus one for the best."""
    mark = np.zeros(marks.num_rows, np.int64)
    mark[np.asarray(marks.column("place"))] = np.asarray(marks.column("mark"))
    best, total = [], []
    for links in rows.column("links").to_pylist():
        place, times = _unsqueeze(links) if links else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        found = mark[place]
        best.append(int(times[found & 1 == 1].sum()))
        total.append(int((times * (found >> 1)).sum()))
    named = {"n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
    return pa.table([named[f.name] if f.name in named else rows.column(f.name) for f in _SUMS], schema=_SUMS)


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK,
          whole: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row.

    ``groups`` is the groups' text (``a1,a2|b1;a3|b2,b3``) if ``whole``, else its lowercase SHA-256, '' without tokens.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        shared = spark.sparkContext.broadcast((a_file.read(), b_file.read()))  # two vocabulary files
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, packer = _pair(shared), _Packer(0)
        for batch in batches:
            for piece in pieces(batch, "body", PIECE):
                ids, bodies = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                packer.add(*_short_rows(pair, ids, bodies, whole), sum(map(len, bodies)))
                yield from packer.flush(BLOCK)
        yield from packer.flush()

    path = fresh_dir(spark, "alignment-packed")
    rows.where(F.octet_length("body") <= chunk_bytes).mapInArrow(run, PACKED).write.option("compression", "zstd").parquet(path)
    links, long = _long_texts(rows, shared, chunk_bytes, whole)
    links.write.mode("append").option("compression", "zstd").parquet(path)

    packed = spark.read.schema(PACKED).parquet(path)
    width = SentencePieceProcessor(model_proto=shared.value[1]).vocab_size()
    pairs = packed.where(F.col("pair").isNotNull()).select("block", "place", "pair", "n")
    counted = pairs.withColumn("count", F.sum("n").over(Window.partitionBy("pair"))).select(
        "block", "place", F.pmod("pair", F.lit(width)).alias("b"), "count")
    best = counted.groupBy("b").agg(F.max("count").alias("best"))  # at most one row for each id of B
    marked = counted.join(F.broadcast(best), "b").select(
        "block", "place", (F.col("count") * 2 + (F.col("count") == F.col("best")).cast("int")).alias("mark"))
    # read anew: the two sides of the cogroup must not share columns
    texts = spark.read.schema(PACKED).parquet(path).where(F.col("pair").isNull()).drop("place", "pair", "n")
    summed = texts.groupBy("block").cogroup(marked.groupBy("block")).applyInArrow(_sums, SUMS)
    shorts = summed.where(F.col("key").isNull()).drop("key")
    parts = summed.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    longs = long.join(parts, "key", "left").drop("key").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
    return shorts.unionByName(longs).withColumn("n_links", F.col("n_a") + F.col("n_b") - F.col("n_groups"))
