"""Op 2: benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to their words (A-Z lower-cased) joined by one space. The automaton holds every
window of ten consecutive item words, and the whole item where it has fewer; it reads each document's
normalised text once. The end of a match is mapped back to word positions and, for callers that
want the passage, to byte offsets in the original text.

Rows are independent: a narrow Arrow map without shuffle. The items are broadcast, in parts whose
automaton has at most about ``PART_NODES`` nodes (a byte of an item is in ten windows at most, each a
path of its own at worst); a larger benchmark is scanned part by part and the hits of a document are merged
in one aggregation, so neither the driver nor a task ever holds more than one part. One item is not split.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.common import appended, extend, pieces, texts, without
from pacewise.session import checkpoint_root

WINDOW = 10                 # words of a window
PART_NODES = 8 << 20        # automaton nodes in one task, about 40 bytes each: 320 MB at most, for 0.8 MB of item texts or more
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else 0x20 for b in range(256))

HITS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("item", T.StringType())]))


def normalised_words(text: str) -> list[bytes]:
    """Words of the contract's pattern: in UTF-8 every byte of a non-ASCII character is a word byte."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows(words: list[bytes], size: int = WINDOW) -> Iterator[list[bytes]]:
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield words[i: i + size]


class Scanner:
    """The automaton over the windows of some items; finds the word spans they cover in a text."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        owners: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            for w in windows(normalised_words(text)):
                key = f" {b' '.join(w).decode('latin-1')} "
                owners.setdefault(key, (len(w), set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for key, (n, names) in owners.items():
            self.automaton.add_word(key, (n, tuple(sorted(names))))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, tuple[str, ...]]]]:
        """Number of words, and (first word, word after the last, items) of each match."""
        words = normalised_words(text)
        if self.empty or not words:
            return len(words), []
        normal = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(normal.decode("latin-1")))
        if not found:
            return len(words), []
        spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 0x20)
        ends = np.searchsorted(spaces, [end for end, _ in found])
        return len(words), [(int(e) - n, int(e), items) for e, (_, (n, items)) in zip(ends, found, strict=True)]


def merged(spans: list[tuple[int, int, tuple[str, ...]]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end, _ in sorted(spans, key=lambda s: s[:2]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans of the original UTF-8 text that hold the given word spans."""
    flat = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], flat.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(starts[a]), int(ends[b - 1])) for a, b in spans]


def contamination(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Adds n_words, n_hit (words inside a window's occurrence), item_ids (sorted strings), hit_spans
    (byte offsets in the original text of the merged hits) and contaminated.

    Null texts and items have no words; a null item id is the string "null". Repeated items count
    once, repeated documents stay. An empty benchmark contaminates nothing. Input columns named like
    a result give way to it.
    """
    kept = without(df, "n_words", "n_hit", "item_ids", "hit_spans", "contaminated")
    items = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"),
                         F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("body"))
    # bytes and separators once for each window they are in; at least an id's worth for an empty item
    nodes = F.lit(WINDOW) * (F.octet_length("body") + 2) + F.octet_length("item") + 64
    size = items.agg(F.sum(nodes.cast("long"))).first()[0] or 0
    parts = -(-int(size) // PART_NODES) or 1
    if parts == 1:
        return _scan(kept, [tuple(r) for r in items.collect()], text)
    # a larger benchmark: scan for one part of the items at a time, then merge a document's hits
    key = F.pmod(F.xxhash64("item", "body"), F.lit(2 * parts))
    checkpoint_root(kept.sparkSession)
    rows = kept.withColumn("__row", F.monotonically_increasing_id()).checkpoint()  # the numbers must stay the same
    found = None
    for k in range(2 * parts):
        part = _scan(rows, [tuple(r) for r in items.where(key == k).collect()], text, raw=True)
        part = part.select("__row", "__hits").where(F.size("__hits") > 0)
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("__row").agg(F.flatten(F.collect_list("__hits")).alias("__hits"))
    joined = rows.join(hits, "__row", "left").drop("__row")
    return _finish(joined, text)


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("item_ids", T.ArrayType(T.StringType())),
          T.StructField("hit_spans", T.ArrayType(T.StructType([
              T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
          T.StructField("contaminated", T.BooleanType())]
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_HITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string())]))


def _columns(rows: list[tuple[str, int, list]]) -> dict[str, pa.Array]:
    n_hit, ids, spans = [], [], []
    for body, _, found in rows:
        joined = merged(found) if found else []
        n_hit.append(sum(b - a for a, b in joined))
        ids.append(sorted({i for f in found for i in f[2]}))
        spans.append([{"start": a, "end": b} for a, b in original_spans(body, joined)] if joined else [])
    return {"n_words": pa.array([n for _, n, _ in rows], pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
            "item_ids": pa.array(ids, pa.list_(pa.string())), "hit_spans": pa.array(spans, _SPANS),
            "contaminated": pa.array([h > 0 for h in n_hit], pa.bool_())}


def _scan(df: DataFrame, items: list[tuple[str, str]], text: str, raw: bool = False) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in batches:
            for piece in pieces(batch, text):
                rows = [(t, *scanner.scan(t)) for t in texts(piece, text)]
                if raw:
                    hits = [[{"start": a, "end": b, "item": i} for a, b, names in f for i in names] for _, _, f in rows]
                    yield extend(piece, __hits=pa.array(hits, _HITS))
                else:
                    yield extend(piece, **_columns(rows))

    return df.mapInArrow(run, appended(df, *([T.StructField("__hits", HITS)] if raw else FIELDS)))


def _finish(df: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                at = piece.schema.get_field_index("__hits")
                rows = [(t, len(normalised_words(t)), [(h["start"], h["end"], (h["item"],)) for h in hits or []])
                        for t, hits in zip(texts(piece, text), piece.column(at).to_pylist(), strict=True)]
                yield extend(piece.drop_columns(["__hits"]), **_columns(rows))

    return df.mapInArrow(run, T.StructType([*without(df, "__hits").schema.fields, *FIELDS]))
