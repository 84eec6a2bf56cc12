"""Op 10: quality rules: base counts and a hashed n-gram classifier.

Features are the means of hashed indicators of words, word pairs and character 3- and 4-grams (UTF-8
bytes); a logistic regression over them is trained on a bounded sample of the labelled rows
(``TRAIN_ROWS``) and calibrated (Platt) on rows held out of the fit. The model is a fixed 1 MB table, which
is broadcast; scoring is a narrow Arrow map over whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.common import appended, extend, pieces, texts, without

TRAIN_ROWS = 2_000      # labelled rows used for training and calibration, at most
HELD_OUT = 4            # every fourth of them calibrates
THRESHOLD = 0.5         # kept if the calibrated probability of good quality is at least this
MIN_WORDS = 50
MAX_REPEATED = 50       # percent of the words in three-word windows found twice or more
BITS = 16               # hash table of each of the four kinds of feature
KINDS = 4
FIT_ROWS = 64           # rows of a block in the fit
EPOCHS, RATE, DECAY = 80, 0.5, 1e-4

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def _hash(x: np.ndarray, factor: int) -> np.ndarray:
    return (x.astype(np.uint32, copy=False) * np.uint32(factor)) >> np.uint32(32 - BITS)


def measured(text: str) -> tuple[dict[str, int], list[np.ndarray]]:
    """The contract's counts, and the hashed features of each kind."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the six ASCII white-space characters only
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    repeated = 0
    if len(ids) >= 3:
        base = len(seen)
        if base < 1 << 20:
            windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
        else:  # three ids of this many bits don't fit into one number: number the pairs first
            _, pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
            windows = pairs[:-1] * base + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            twice = np.zeros(len(windows) + 1, bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            covered = np.zeros(len(ids), bool)
            for k in range(3):
                covered[k: k + len(windows)] |= twice[:-1]
            repeated = int(covered.sum())
    counts = {"n_words": len(words), "word_chars": len(text) - (len(raw) - len(raw.translate(None, _SPACE))),
              "n_symbols": len(raw) - len(raw.translate(None, _SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
              "n_repeat_words": repeated}
    word = np.fromiter(map(zlib.crc32, seen), np.uint32, len(seen))[ids] if words else np.zeros(0, np.uint32)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    three = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    return counts, [_hash(word, 0x9E3779B1), _hash(word[:-1] * np.uint32(31) + word[1:], 0x85EBCA6B),
                    _hash(three, 0xC2B2AE35), _hash(three[:-1] | b[3:] << 24, 0x27D4EB2F)]


class Model:
    """Weights of every kind of feature, bias and calibration."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0) -> None:
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def logit(self, features: list[np.ndarray]) -> float:
        return self.bias + sum(float(w[f].mean(dtype=np.float64)) for w, f in zip(self.weights, features, strict=True) if len(f))

    def probability(self, features: list[np.ndarray]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.logit(features) + self.shift, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model | None:
    """Logistic regression on rows (feature index, mean value, label); None without both classes."""
    train = [r for k, r in enumerate(rows) if k % HELD_OUT]
    held = [r for k, r in enumerate(rows) if k % HELD_OUT == 0]
    if len({r[2] for r in train}) < 2:
        return None
    label = np.array([r[2] for r in train], np.float64)
    share = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))  # both classes weigh the same
    w, b = np.zeros(KINDS << BITS), 0.0
    sum_w, sum_b = np.full(len(w), 1e-8), 1e-8
    for _ in range(EPOCHS):  # full-batch Adagrad: the same rows give the same model
        z = _logits(train, w) + b
        g = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(train)
        gw = np.zeros(len(w))
        for start, at, value, row in _blocks(train):
            np.add.at(gw, at, value * g[start:][row])  # one by one in the rows' order, whatever the blocks
        gw, gb = gw + DECAY * w / len(train), g.sum()
        sum_w += gw**2
        sum_b += gb**2
        w -= RATE * gw / np.sqrt(sum_w)
        b -= RATE * gb / np.sqrt(sum_b)
    model = Model(w.astype(np.float32).reshape(KINDS, 1 << BITS), float(b))
    if len({r[2] for r in held}) == 2:
        model.slope, model.shift = _platt(_logits(held, w) + b, np.array([r[2] for r in held], np.float64))
    return model


def _blocks(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, feature indices, values and row numbers of ``FIT_ROWS`` rows after the other: the sample is held
    once, as it came, and what a pass makes of it is never larger than a block."""
    for start in range(0, len(rows), FIT_ROWS):
        block = rows[start: start + FIT_ROWS]
        yield (start, np.concatenate([r[0] for r in block]), np.concatenate([r[1] for r in block]).astype(np.float64),
               np.repeat(np.arange(len(block)), [len(r[0]) for r in block]))


def _logits(rows: list[tuple[np.ndarray, np.ndarray, int]], w: np.ndarray) -> np.ndarray:
    return np.concatenate([np.bincount(row, value * w[at], min(FIT_ROWS, len(rows) - start)) for start, at, value, row in _blocks(rows)])


def _platt(z: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid over the logits, with Platt's smoothed targets (Newton steps)."""
    yes, no = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        r, v = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[v @ (z * z) + 1e-6, v @ z], [v @ z, v.sum() + 1e-6]])
        step = np.linalg.solve(h, np.array([r @ z, r.sum()]))
        a, c = a - step[0], c - step[1]
        if abs(step).max() < 1e-8:
            break
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """A model from the labelled documents (a bounded sample, chosen by hash of the id; the rest of
    the operator covers all rows). Rows without label, id or text teach nothing."""
    chosen = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)")
              .orderBy(F.xxhash64("id"), "id", "y").limit(TRAIN_ROWS))
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("body")).where("body is not null")
    rows = body.join(F.broadcast(chosen), "id")  # TRAIN_ROWS rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body"):
                at, value = [], []
                for t in texts(piece, "body"):
                    found = [np.unique(f, return_counts=True) for f in measured(t)[1]]
                    at.append(np.concatenate([u.astype(np.int32) + (k << BITS) for k, (u, _) in enumerate(found)]).tobytes())
                    value.append(np.concatenate([n / max(1, n.sum()) for _, n in found]).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_pydict({"id": piece.column(0).cast(pa.string()), "y": piece.column(piece.schema.get_field_index("y")),
                                                  "at": pa.array(at, pa.binary()), "value": pa.array(value, pa.binary())})

    sample = rows.mapInArrow(run, "id string, y int, at binary, value binary").orderBy(F.xxhash64("id"), "id", "y", "at").limit(TRAIN_ROWS).collect()
    return fit([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32), r["y"]) for r in sample])


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
          T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
          T.StructField("base_failed", T.BooleanType()), T.StructField("quality_probability", T.DoubleType()),
          T.StructField("kept", T.BooleanType())]


def rules(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds the base counts, base_failed, quality_probability and kept.

    Null and empty texts have no words and fail the base rule. Without a model (no labelled rows of
    both classes) the probability is null and the base rule alone decides. Rows are independent; input
    columns named like a result give way.
    """
    kept = without(df, *[f.name for f in FIELDS])
    shared = kept.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for piece in pieces(batch, text):
                counts, probability = [], []
                for t in texts(piece, text):
                    c, features = measured(t)
                    counts.append(c)
                    probability.append(None if m is None else m.probability(features))
                new = {f.name: pa.array([c[f.name] for c in counts], pa.int64()) for f in FIELDS[:5]}
                failed = [c["n_words"] < MIN_WORDS or 100 * c["n_repeat_words"] > MAX_REPEATED * c["n_words"] for c in counts]
                yield extend(piece, **new, base_failed=pa.array(failed, pa.bool_()), quality_probability=pa.array(probability, pa.float64()),
                             kept=pa.array([not f and (p is None or p >= THRESHOLD) for f, p in zip(failed, probability, strict=True)], pa.bool_()))

    return kept.mapInArrow(run, appended(kept, *FIELDS))
