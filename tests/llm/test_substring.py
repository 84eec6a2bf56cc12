"""Op 4 against brute force, and edge rows."""

import hashlib
import random

import pytest

from conftest import SF001
from pacewise.llm import queries, substring


def brute(docs):
    least = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            key, place = tuple(w[k: k + 13]), (d is None, d or 0)
            least[key] = min(least.get(key, place), place)
    out = []
    for d, t in docs:
        w = (t or "").encode().split()
        gone = {k + j for k in range(len(w) - 12) if least[tuple(w[k: k + 13])] < (d is None, d or 0) for j in range(13)}
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def run(spark, docs, parts=4):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, n_words int, kept string").repartition(parts)
    rows = substring.remove_repeats(df).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=str)


def sample(seed, n):
    rnd = random.Random(seed)
    passages = [[f"p{k}_{j}" for j in range(rnd.randrange(5, 60))] for k in range(8)]
    docs = []
    for d in range(n):
        w = []
        for _ in range(rnd.randrange(6)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            w += p[a: a + rnd.randrange(1, 50)] if rnd.random() < 0.6 else [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(30))]
        docs.append((d, " ".join(w)))
    docs += [(n, None), (n + 1, ""), (None, docs[3][1]), (n + 2, " ".join("ab"[k % 2] for k in range(60))), (n + 3, " ".join("ab"[k % 2] for k in range(41)))]
    return docs + [(5, docs[5][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, seed, monkeypatch):
    docs = sample(seed, 60)
    if seed == 2:  # many chunks and ranges
        monkeypatch.setattr(substring, "CHUNK_WORDS", 50)
        monkeypatch.setattr(substring, "RANGE_WORDS", 100)
    assert run(spark, docs) == brute(docs)


def test_every_offset_of_a_passage(spark):
    passage = [f"q{k}" for k in range(13)]
    docs = [(k, " ".join([f"a{k}_{j}" for j in range(k)] + passage + [f"b{k}_{j}" for j in range(5)])) for k in range(15)]
    docs += [(20, " ".join(passage[:12])), (21, " ".join(passage[1:] + ["z"]))]
    assert run(spark, docs) == brute(docs)


def test_long_text_and_no_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    docs = [(1, "x " + long), (2, long)]
    assert run(spark, docs, 1) == brute(docs)
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 0, "")]


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op4_substring(spark, SF001).collect()), key=str)
    want = [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(docs)]
    assert got == want and any(g for _, _, g, _ in want)
