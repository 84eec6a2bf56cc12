"""Op 12 against a plain alignment of every text by the libraries, and the laws of the fragments."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from conftest import SF001
from pacewise.llm import alignment, queries

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("N_A", T.StringType())])
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
BYTES = {c: b for b, c in zip(
    [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100), *range(0x21), *range(0x7F, 0xA1), 0xAD],
    [chr(b) for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]] + [chr(0x100 + i) for i in range(68)], strict=True)}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(queries.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)


def tokens(libraries, text):
    a, b = libraries
    x = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(BYTES[c] for c in t)) for i, t in zip(x.ids, x.tokens, strict=True)]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
             for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
    return left, right


def plain(libraries, text):
    """The groups' text, number of groups and all links of one text."""
    if not text:
        return None
    left, right = tokens(libraries, text)
    data = b" " + text.encode()
    if b"".join(x for _, x in left) != data or b"".join(x for _, x in right) != data:
        return None
    spans = []
    for side in (left, right):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        spans.append(out)
    cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, lo = [], 0
    for c in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in side if lo < e <= c) for side in spans))
        lo = c
    links = [(i, j) for i, s, e in spans[0] for j, t, u in spans[1] if s < u and t < e]
    return len(left), len(right), groups, links


def brute(libraries, docs):
    made = [(d, plain(libraries, t)) for d, t in docs]
    count = Counter(p for _, m in made if m for p in m[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return sorted([(d, m[0], m[1], len(m[2]), len(m[3]), sum(count[p] == best[p[1]] for p in m[3]), sum(count[p] for p in m[3]), ";".join(m[2]))
                   if m else (d, 0, 0, 0, 0, 0, 0, "") for d, m in made], key=str)


def compare(spark, libraries, docs, **options):
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS)
    want = brute(libraries, docs)
    got = alignment.align(df, queries.BYTE_BPE, queries.PIECE_BPE, whole=True, **options).select(*COLUMNS).collect()
    assert sorted([tuple(r) for r in got], key=str) == want


def sample():
    rnd = random.Random(6)
    pieces = ["The quick", "naïve façade", "привет мир", "日本語テキスト", "<|endoftext|>", "</s> <s>", "  two", "\n\n", "\tTab", "don't", "12345", "🙂👍🏽",
              "é", "x y", "...", "﷽", "supercalifragilistic", "▁low", "a　b"]
    docs = [(i, " ".join(rnd.choice(pieces) for _ in range(rnd.choice([1, 3, 20, 60])))) for i in range(50)]
    plain_words = " ".join(rnd.choice(["the", "of", "Wort", "été", "слово", "unbelievable", "x1"]) for _ in range(700))
    return docs + [(50, None), (51, ""), (52, " "), (53, "▁"), (7, "same id, other text"), (None, "no id"), (None, "no id"), (None, None),
                   (60, plain_words), (61, plain_words + "▁ not reproduced"), (62, "一" * 1500), (63, plain_words)]


def test_equals_brute_force(spark, libraries):
    compare(spark, libraries, sample())


@pytest.mark.parametrize("size", [64, 300])
def test_chunks_of_long_texts(spark, libraries, size):
    """Ranges of a few bytes: most texts are long, their fragments are composed over several levels."""
    compare(spark, libraries, sample(), chunk_bytes=size)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(None, "")]])
def test_empty(spark, libraries, docs):
    compare(spark, libraries, docs, chunk_bytes=100)


def test_composition_is_associative(libraries):
    """Any cutting of a token sequence, composed in any order, gives the groups of the whole."""
    with open(queries.BYTE_BPE, encoding="utf-8") as a, open(queries.PIECE_BPE, "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["unbelievable", "naïve", "日本語", "don't", "x9"]) for _ in range(80))
    same, a, _, b, _ = pair.encode([text.encode()])
    assert same.all()
    size = len(text.encode()) + 1
    for _ in range(30):
        edges = sorted({0, size, *(rnd.randint(1, size - 1) for _ in range(rnd.randint(1, 25)))})
        parts = [alignment.fragment(pair, a, b, lo, hi, k)[0] for k, (lo, hi) in enumerate(zip(edges, edges[1:]))]
        seams = []

        def fold(parts):
            if len(parts) == 1:
                return parts[0]
            cut = rnd.randint(1, len(parts) - 1)
            whole, closed = fold(parts[:cut]).then(fold(parts[cut:]))
            if closed:
                seams.append((closed[0], tuple(closed[1][0].tolist()), tuple(closed[1][1].tolist())))
            return whole

        whole = fold(parts)
        found = sorted(seams)
        seams = []
        left, closed = parts[0], None
        for p in parts[1:]:
            left, closed = left.then(p)
            if closed:
                seams.append((closed[0], tuple(closed[1][0].tolist()), tuple(closed[1][1].tolist())))
        assert sorted(seams) == found
        assert [x.tolist() for x in (*left.prefix, *left.suffix)] == [x.tolist() for x in (*whole.prefix, *whole.suffix)]
        assert left.first == whole.first and not len(whole.suffix[0])


def test_kept_stretches_give_the_libraries_ids(libraries):
    """Texts encoded from kept stretches, new and seen before, against the libraries over whole texts."""
    with open(queries.BYTE_BPE, encoding="utf-8") as a, open(queries.PIECE_BPE, "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    texts = [t for _, t in sample() if t] * 2
    rnd = random.Random(11)
    marks = [" ", "  ", "\n", "\u00a0", "\u3000", "'s", "a", "Z", "é", "×", "÷", "я", "ɏ", "5", "_", "日", "\u0301", "▁", "\u2028", "ͅ", "ǆ", "'", "ll"]
    texts += ["".join(rnd.choice(marks) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    for part in (texts[:500], texts[500:], texts):
        same, x, n_x, y, n_y = pair.encode([t.encode() for t in part])
        xs, ys = np.split(x, np.cumsum(n_x)[:-1]), np.split(y, np.cumsum(n_y)[:-1])
        for t, s, i, j in zip(part, same, xs, ys, strict=True):
            left, right = tokens(libraries, t)
            data = b" " + t.encode()
            assert s == (b"".join(b for _, b in left) == data == b"".join(b for _, b in right)), repr(t)
            if s:
                assert i.tolist() == [k for k, _ in left] and j.tolist() == [k for k, _ in right], repr(t)


def test_windows_cover_the_text():
    data = (" " + " ".join(["word"] * 3000) + "日" * 3000 + " tail of words" * 300).encode()
    at = 0
    for window, skip, stop in alignment.chunks_of(data, 1000):
        start = at - skip
        assert data[start:start + len(window)] == window and start + stop <= len(data)
        at = start + stop
    assert at == len(data)


def test_query(spark, libraries):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.QUERIES["op12_alignment"](spark, SF001).collect()
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute_fast(libraries, docs)]
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def brute_fast(libraries, docs):
    """``brute`` with a sweep instead of all token pairs, for whole texts."""
    made = []
    for d, t in docs:
        left, right = tokens(libraries, t) if t else ([], [])
        data = b" " + (t or "").encode()
        if not t or b"".join(x for _, x in left) != data or b"".join(x for _, x in right) != data:
            made.append((d, None))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (left, right)]
        i = j = 0
        groups, links, a, b = [], [], [], []
        while i < len(left):
            links.append((left[i][0], right[j][0]))
            x, y = ends[0][i], ends[1][j]
            if x <= y:
                a.append(str(left[i][0]))
                i += 1
            if y <= x:
                b.append(str(right[j][0]))
                j += 1
            if x == y:
                groups.append(f"{','.join(a)}|{','.join(b)}")
                a, b = [], []
        made.append((d, (len(left), len(right), groups, links)))
    count = Counter(p for _, m in made if m for p in m[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return [(d, m[0], m[1], len(m[2]), len(m[3]), sum(count[p] == best[p[1]] for p in m[3]), sum(count[p] for p in m[3]), ";".join(m[2]))
            if m else (d, 0, 0, 0, 0, 0, 0, "") for d, m in made]
