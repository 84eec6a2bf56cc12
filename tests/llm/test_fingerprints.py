"""Op 13 against a plain Python version, and edge rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from pacewise.llm import fingerprints, queries

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("FINGERPRINT", T.StringType())])
M = 0xFFFFFFFF


def rot(x, r):
    return ((x << r) | (x >> (32 - r))) & M


def mix(h, k):
    k = rot(k * 0xCC9E2D51 & M, 15) * 0x1B873593 & M
    return (rot(h ^ k, 13) * 5 + 0xE6546B64) & M


def final(h, n):
    h ^= n
    h = (h ^ (h >> 16)) * 0x85EBCA6B & M
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & M
    return h ^ (h >> 16)


def hash_ints(values, seed=42):
    """Murmur3, 32 bits, over a chain of ints."""
    for v in values:
        seed = final(mix(seed, v & M), 4)
    return seed - (1 << 32) if seed >> 31 else seed


def hash_text(text):
    data, h = text.encode(), 42
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = mix(h, int.from_bytes(data[i:i + 4], "little"))
    for b in data[whole:]:
        h = mix(h, (b - 256 if b > 127 else b) & M)
    h = final(h, len(data))
    return h - (1 << 32) if h >> 31 else h


def prints(text):
    h = [hash_text(w) for w in re.findall("[^\x20\x09-\x0d]{1,16}", text)]
    if len(h) < 7:
        return [hash_ints(h)] if h else []
    out = []
    for i in range(len(h) - 6):
        inner = [hash_ints(h[j:j + 2]) for j in range(i, i + 6)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(hash_ints(h[i:i + 7]))
    return out


def likeness(a, b):
    if not a and not b:
        return 1.0
    first = [{x: len(p) - 1 - i for i, x in enumerate(reversed(p))} for p in (a, b)]
    shifts = sorted(first[1][x] - first[0][x] for x in first[0] if x in first[1])
    near = sum(abs(s - shifts[len(shifts) // 2]) <= 64 for s in shifts)
    return 2.0 * near / (len(first[0]) + len(first[1]))


def brute(docs, tie):
    docs = [(d, t or "") for d, t in docs]
    order = sorted(set(docs), key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    after = {r: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    out = []
    for r in docs:
        third = len(r[1]) // 3
        edited = r[1][:len(r[1]) - third] + after[r][:third]
        out.append((r[0], len(r[1]), hashlib.sha256(edited.encode()).hexdigest(), prints(r[1]), prints(edited),
                    likeness(prints(r[1]), prints(edited)), likeness(prints(r[1]), prints(after[r]))))
    return sorted(out, key=str)


def compare(spark, docs):
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS)
    tie = {r["t"]: r["h"] for r in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    got = fingerprints.with_edits(df).select("doc_id", "n_chars", F.sha2("edited", 256), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, tie)


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    pick = lambda n: " ".join(rnd.choice(["la", "übel", "日本語", "x" * 40, "word", "of", "\t", "a\x0bb", "𝒳y"]) for _ in range(n))
    docs = [(i, pick(rnd.choice([0, 1, 3, 9, 60, 300]))) for i in range(60)]
    docs += [(60, docs[5][1]), (7, "other text under the same id"), (7, docs[7][1]), (7, docs[7][1]), (None, "no id " * 9), (None, None), (None, None),
             (70, None), (71, ""), (72, " \n"), (80, "日" * 500), (-3, "negative id"), (90, "one two three four five six seven")]
    compare(spark, docs)


@pytest.mark.parametrize("docs", [[], [(1, "only one text of some eight words is here")], [(None, None)], [(5, "same same"), (5, "same same")]])
def test_few_rows(spark, docs):
    compare(spark, docs)


def test_very_long_text(spark):
    rnd = random.Random(2)
    compare(spark, [(1, " ".join(str(rnd.randint(0, 5000)) for _ in range(60_000))), (2, "short"), (3, "z" * 100_000)])


def test_moved_text_keeps_its_anchors():
    rnd = random.Random(8)
    text = " ".join(str(rnd.randint(0, 10**6)) for _ in range(400))
    assert likeness(prints(text), prints("a few new words first " + text)) > 0.95


def test_query_tells_edits_from_neighbours(spark):
    rows = queries.QUERIES["op13_fingerprints"](spark, SF001).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    tie = {t or "": 0 for t in docs.values()}  # ids are unique there
    want = {r[0]: r for r in brute(list(docs.items()), tie)}
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) == (w[1], w[2], w[5], w[6])
        assert r["fingerprint"] == " ".join(f"{x & M:x}" for x in w[3]) and r["edited_fingerprint"] == " ".join(f"{x & M:x}" for x in w[4])
    long = [r for r in rows if r["n_chars"] > 500]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5 > 0.1 > sum(r["near_next"] for r in long) / len(long)
