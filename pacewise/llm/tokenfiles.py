"""Op 6: token-id files, compressed by Re-Pair grammars.

Documents are dealt out by ranges of their id (rows of one id, or of none, by ranges of how their text
begins) and sorted, so parts hold them in ascending order. Each part is a run of blocks of whole documents
(about ``BLOCK_TOKENS`` ids; one document larger than that is a block of its own), which are the shards that
have a grammar each. In a block, frequent pairs of neighbouring symbols are replaced by new symbols round after
round until no pair pays, never across the end of a document; the rules and the length of each rule's expansion
are stored with the block, so one document can be decoded alone.

File format, little-endian, one block a row of a Parquet table (shard: number of the part, block, n_docs, n_tokens,
payload), which gives atomic commits in any file system Spark writes to. The payload:
    magic "RPG2", uint32 n_docs, n_rules, base, n_ids, n_symbols, symbol width in bytes (2 or 4)
    int64  document ids, n_docs (NO_ID: null)
    uint32 ids of each document, n_docs
    uint32 first symbol of each document, n_docs
    uint32 the distinct token ids of the block, n_ids; symbol k < n_ids is the k-th of them
    uint32 expansion length of each rule, n_rules; rule k is symbol n_ids + k
    uint   left and right symbol of each rule, n_rules each, and the symbols, n_symbols, all of the given width
"""

from __future__ import annotations

import gc
import os
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from pacewise.llm.bpe import byte_symbols, is_plain, plain_pretokens, read_vocabulary
from pacewise.llm.common import pieces, texts, without

END_ID = 1
BLOCK_TOKENS = 1 << 20
MIN_COUNT = 10          # a rule takes 8 bytes and a replacement saves 2, but overlaps take some of what is counted
NO_ID = np.iinfo(np.int64).max
MAGIC = b"RPG2"
_WORDS = 350_000
PREFIX = 64              # characters of a text that part the rows of one id


class LibraryEncoder:
    """The tokenizer library's ids of whole texts.

    Of plain texts (``is_plain``) the library's normalizer and word splitter do no more than lower-case and cut at known
    characters, so these are cut here, each distinct word of some texts once, and the library's model encodes the
    new pieces; its answers are kept (bounded). A piece's ids end with the one token that ends a word. Texts with
    special tokens or other characters go to the library whole.
    """

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library, self.model = Tokenizer.from_str(spec), Tokenizer.from_str(spec)
        for t in (self.library, self.model):
            t.no_truncation()
            t.no_padding()
        self.model.normalizer, self.model.pre_tokenizer = None, CharDelimiterSplit(" ")
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.base = self.library.get_vocab_size(with_added_tokens=True)
        self.pretokens = plain_pretokens()
        self.symbols = str.maketrans({chr(b): c for c, b in byte_symbols().items()})
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(self.base)])

    def _learn(self, new: list[str]) -> None:
        """Keeps the ids of new words, and of the pieces of those that are cut; words of letters are one piece."""
        words, older = self.words, self.older
        whole = [w for w in new if w.isalpha()]
        rest = [w for w in new if not w.isalpha()]
        cut = list(map(self.pretokens.findall, rest))
        met = set(chain.from_iterable(cut)).difference(whole).difference(words)
        words.update({p: older[p] for p in met if p in older})
        ask = whole + [p for p in met if p not in words]
        spelled = [p if p.isascii() else p.encode().decode("latin-1").translate(self.symbols) for p in ask]
        made = self.model.encode_batch_fast([" ".join(spelled[k: k + 500]) for k in range(0, len(ask), 500)], add_special_tokens=False)
        found = np.concatenate([np.array(m.ids, "<u4") for m in made]) if ask else np.zeros(0, "<u4")
        raw, stop = found.tobytes(), (4 * (np.flatnonzero(self.ends[found]) + 1)).tolist()
        if len(stop) != len(ask):
            raise ValueError("the vocabulary doesn't mark the end of every piece of a word")
        words.update(zip(ask, map(raw.__getitem__, map(slice, [0, *stop[:-1]], stop)), strict=True))
        get = words.__getitem__
        words.update({w: b"".join(map(get, ps)) for w, ps in zip(rest, cut, strict=True)})

    def encode(self, bodies: list[str]) -> list[bytes]:
        gc.disable()  # hundreds of thousands of strings and no cycles
        try:
            return self._encode(bodies)
        finally:
            gc.enable()

    def _encode(self, bodies: list[str]) -> list[bytes]:
        plain = ["<|" not in t and is_plain(t) for t in bodies]
        cut = pc.ascii_split_whitespace(pa.array([t.lower() for t, p in zip(bodies, plain, strict=True) if p], pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        if len(self.words) > _WORDS:  # a word met again moves on from the older generation
            self.words, self.older = {}, self.words
        names, words, older = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words, self.older
        missing = [w for w in names if w not in words]
        words.update({w: older[w] for w in missing if w in older})
        self._learn([w for w in missing if w not in words])
        found = list(map(words.__getitem__, names))
        at, ends = coded.indices.to_numpy().tolist(), iter(np.cumsum(pc.list_value_length(cut)).tolist())
        out, start = [], 0
        for t, p in zip(bodies, plain, strict=True):
            if p:
                end = next(ends)
                out.append(b"".join(map(found.__getitem__, at[start: end])))
                start = end
            else:
                out.append(array("I", self.library.encode(t, add_special_tokens=False).ids).tobytes())
        return out


_ENCODERS: dict[int, LibraryEncoder] = {}


def worker_encoder(spec: str) -> LibraryEncoder:
    """This Python worker's encoder; later tasks go on with the words it knows."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LibraryEncoder(spec)
    return _ENCODERS[key]


def _hashed(key: np.ndarray, turn: int, bits: int) -> np.ndarray:
    """A table slot for each key; every turn parts the keys that another one puts together."""
    if key.dtype == np.uint32:
        return (key * np.uint32(0x9E3779B1 * (2 * turn + 1) & 0xFFFFFFFF)) >> np.uint32(32 - bits)
    return (key * np.uint64(0x9E3779B97F4A7C15 * (2 * turn + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - bits)


def repair(seq: np.ndarray, last: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (left, right) and whether each symbol ends a document; rule k is symbol ``top`` + k.

    Each round replaces every pair counted ``MIN_COUNT`` times or more, and rounds go on until there is none. A pair
    under that can't reach it later, so a round looks only at pairs with a symbol of the round before and at those
    that shared a slot of the counting table with another pair.
    """
    seq, left, right, turn = seq.astype(np.uint32), [], [], 0
    look = ~last[:-1]
    while len(at := np.flatnonzero(look)):
        wide = np.uint32 if top <= 1 << 16 else np.uint64
        key = seq[at].astype(wide, copy=False) << wide(16 if wide is np.uint32 else 32) | seq[at + 1]
        bits = min(20, max(8, len(at).bit_length() + 1))
        slot = _hashed(key, turn, bits)
        turn += 1
        often = (np.bincount(slot, minlength=1 << bits) >= MIN_COUNT)[slot]
        at, key, slot = at[often], key[often], slot[often]
        owner = np.zeros(1 << bits, wide)
        owner[slot] = key  # of the pairs in one slot one is counted, the others wait for the next turn
        own = owner[slot] == key
        look[:] = False
        look[at[~own]] = True
        at, slot = at[own], slot[own]
        enough = (np.bincount(slot, minlength=1 << bits) >= MIN_COUNT)[slot]
        at, slot = at[enough], slot[enough]
        if not len(at):
            continue
        # where chosen pairs overlap, every other one of the run is replaced, from its left end
        start = np.concatenate(([True], np.diff(at) > 1))
        run = np.maximum.accumulate(np.where(start, at, 0))
        take = (at - run) % 2 == 0
        at, slot = at[take], slot[take]
        used = np.bincount(slot, minlength=1 << bits) > 0
        pairs, first = owner[used], top
        symbol = np.cumsum(used, dtype=np.int64) + (top - 1)
        shift, mask = wide(16 if wide is np.uint32 else 32), wide(0xFFFF if wide is np.uint32 else 0xFFFFFFFF)
        left.append((pairs >> shift).astype(np.uint32))
        right.append((pairs & mask).astype(np.uint32))
        top += len(pairs)
        seq[at] = symbol[slot]
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        look = np.append(look, False)[keep][:-1]
        seq, last = seq[keep], last[keep]
        made = seq >= first
        look = (look | made[:-1] | made[1:]) & ~last[:-1]
    rules = np.stack([np.concatenate(left), np.concatenate(right)], 1) if left else np.zeros((0, 2), np.uint32)
    return seq, rules, last


def pack_block(doc_ids: list[int | None], ids: list[bytes], base: int) -> bytes:
    sizes = np.array([len(i) // 4 for i in ids], np.uint32)
    flat = np.frombuffer(b"".join(ids), "<u4")
    last = np.zeros(len(flat), bool)
    last[np.cumsum(sizes, dtype=np.int64) - 1] = True
    met = np.zeros(base, bool)
    met[flat] = True
    alphabet = np.flatnonzero(met).astype("<u4")
    symbols, rules, last = repair((np.cumsum(met) - 1)[flat], last, len(alphabet))
    lengths = [1] * len(alphabet)
    for a, b in rules.tolist():  # a rule uses earlier symbols only
        lengths.append(lengths[a] + lengths[b])
    first = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)).astype("<u4")
    kind = "<u2" if len(lengths) <= 1 << 16 else "<u4"
    order = np.array([NO_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join([
        MAGIC, struct.pack("<6I", len(ids), len(rules), base, len(alphabet), len(symbols), int(kind[-1])), order.tobytes(), sizes.astype("<u4").tobytes(),
        first.tobytes(), alphabet.tobytes(), np.array(lengths[len(alphabet):], "<u4").tobytes(),
        rules[:, 0].astype(kind).tobytes(), rules[:, 1].astype(kind).tobytes(), symbols.astype(kind).tobytes()])


class Block:
    """Random access to the documents of a payload. Symbols from ``base`` on are rules, smaller ones ids."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        n, r, self.base, met, s, width = struct.unpack_from("<6I", payload, 4)
        at = 28

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.sizes, self.first = part("<i8", n), part("<u4", n), part("<u4", n)
        named = np.concatenate((part("<u4", met), self.base + np.arange(r, dtype="<u4")))
        self.lengths = part("<u4", r)
        self.left, self.right, self.symbols = (named[part(f"<u{width}", count)] for count in (r, r, s))

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        out = symbols.astype(np.int64)
        while len(at := np.flatnonzero(out >= self.base)):
            wide = np.ones(len(out), np.int64)
            wide[at] = 2
            place = np.cumsum(wide) - wide
            rule, grown = out[at] - self.base, np.repeat(out, wide)
            grown[place[at]], grown[place[at] + 1] = self.left[rule], self.right[rule]
            out = grown
        return out.astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own symbols alone."""
        end = self.first[k + 1] if k + 1 < len(self.first) else len(self.symbols)
        return self.expand(self.symbols[self.first[k]: end])

    def documents(self) -> Iterator[np.ndarray]:
        """All documents: every rule is expanded once, and its ids are copied to where it is used."""
        is_rule = self.symbols >= self.base
        rule = self.symbols[is_rule].astype(np.int64) - self.base
        spelled = np.concatenate((self.symbols[~is_rule], self.expand(self.base + np.arange(len(self.left)))))
        begins = np.cumsum(self.lengths, dtype=np.int64) - self.lengths + int((~is_rule).sum())
        size, source = np.ones(len(self.symbols), np.int64), np.empty(len(self.symbols), np.int64)
        size[is_rule], source[is_rule], source[~is_rule] = self.lengths[rule], begins[rule], np.arange(int((~is_rule).sum()))
        ends = np.cumsum(size)
        ids = spelled[np.arange(int(ends[-1])) + np.repeat(source - ends + size, size)]
        return iter(np.split(ids, np.cumsum(self.sizes, dtype=np.int64)[:-1]))


def write(df: DataFrame, path: str, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all texts, each with an end id, in ascending order of the (integer) document id.

    Null ids come last; rows of one id are ordered by text and dealt out by its first ``PREFIX`` characters. A null text is empty: its document holds the
    end id alone. Other columns are ignored; no rows make no block.
    """
    docs = without(df, *[c for c in df.columns if c not in (doc_id, text)]).select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(int(NO_ID))).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    dealt = docs.repartitionByRange("doc", F.substring("text", 1, PREFIX)).sortWithinPartitions("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, docs_here, ids_here, size = TaskContext.get().partitionId(), 0, [], [], 0
        encoder = worker_encoder(spec.value)

        def made() -> pa.RecordBatch:
            payload = pack_block(docs_here, ids_here, encoder.base)
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                                               "n_docs": pa.array([len(ids_here)], pa.int64()), "n_tokens": pa.array([size], pa.int64()),
                                               "payload": pa.array([payload], pa.binary())})

        end = struct.pack("<I", END_ID)
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                for d, ids in zip(piece.column(0).to_pylist(), encoder.encode(texts(piece, "text")), strict=True):
                    docs_here.append(d)
                    ids_here.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= BLOCK_TOKENS:
                        yield made()
                        block, docs_here, ids_here, size = block + 1, [], [], 0
        if ids_here:
            yield made()

    dealt.mapInArrow(run, "shard int, block int, n_docs bigint, n_tokens bigint, payload binary").write.parquet(path)


def read(df: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) for every document of the files (``spark.read.parquet`` of the path).

    start counts the ids of all documents before: sums of the shards, of the blocks before in the
    shard, and of the documents before in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                block = Block(payload.as_py())
                n = len(block.sizes)
                before = np.cumsum(block.sizes, dtype=np.int64) - block.sizes
                ids = pa.array([d.tobytes() for d in block.documents()], pa.binary())
                rows = pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard] * n, pa.int32()), "block": pa.array([number] * n, pa.int32()),
                    "doc_id": pa.array(block.doc_ids, mask=block.doc_ids == NO_ID), "before": pa.array(before),
                    "n_tokens": pa.array(block.sizes.astype(np.int64)), "ids": ids})
                yield from pieces(rows, "ids")

    return df.select("shard", "block", "payload").mapInArrow(run, "shard int, block int, doc_id bigint, before bigint, n_tokens bigint, ids binary")


def block_starts(df: DataFrame) -> DataFrame:
    """(shard, block, block_start) of the files; only one row a shard meets in one task."""
    sums = df.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shard_start = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("shard", shard_start.alias("shard_start"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.select("shard", "block", inside.alias("inside")).join(starts, "shard").select(
        "shard", "block", (F.col("inside") + F.col("shard_start")).alias("block_start"))


def digests(df: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files."""
    found = read(df).select("shard", "block", "doc_id", "before", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))
    return found.join(block_starts(df), ["shard", "block"]).select(
        "doc_id", (F.col("before") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32")
