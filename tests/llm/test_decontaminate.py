"""Op 2 against a brute-force search, and edge rows."""

import hashlib
import random
import re

from pyspark.sql import types as T

from conftest import SF001
from pacewise.llm import decontaminate, queries

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("N_HIT", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = {}
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for i, body in items:
            b = words(body)
            size = min(10, len(b))
            for k in range(len(b) - size + 1 if b else 0):
                for at in range(len(w) - size + 1):
                    if w[at: at + size] == b[k: k + size]:
                        hit.update(range(at, at + size))
                        ids.add("null" if i is None else str(i))
        out.setdefault(d, []).append((len(w), len(hit), sorted(ids)))
    return {d: sorted(x) for d, x in out.items()}


def compare(spark, docs, items):
    out = decontaminate.contamination(spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS),
                                      spark.createDataFrame(items, ITEMS))
    assert [c.lower() for c in out.columns].count("n_hit") == 1
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], r["item_ids"]))
        assert r["contaminated"] == (r["n_hit"] > 0)
        raw = (r["text"] or "").encode()
        spanned = [w for s in r["hit_spans"] for w in words(raw[s["start"]: s["end"]].decode())]
        assert len(spanned) == r["n_hit"]
    assert {d: sorted(x) for d, x in got.items()} == brute(docs, items)


def sample():
    rnd = random.Random(3)
    pick = lambda n: " ".join(rnd.choice(["a", "b", "C", "é", "x9"]) for _ in range(n))
    items = [(1, pick(10)), (2, pick(30)), (3, "Short item"), (4, None), (5, ""), (11, pick(12)), (11, pick(12)),
             (None, "no-id here"), (6, "a b")]
    docs = [(k, pick(rnd.randint(0, 60))) for k in range(20)] + [(20, None), (21, ""), (22, "... !")]
    docs += [(30, f"{pick(5)} -- {items[1][1].upper()}, SHORT  item. {items[0][1]}"), (30, "no ID here"), (None, items[5][1])]
    return docs, items


def test_brute_force(spark):
    compare(spark, *sample())


def test_benchmark_larger_than_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_NODES", 3000)
    compare(spark, *sample())


def test_empty_tables(spark):
    docs, items = sample()
    compare(spark, docs[:3], [])
    compare(spark, [], items)


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    grams = {tuple(w[k: k + 10]) for _, b in items for w in [words(b)] for k in range(max(1, len(w) - 9))}
    suspects = [(d, t) for d, t in docs if any(tuple(w[k: k + 10]) in grams for w in [words(t)] for k in range(len(w)))]
    want = brute(suspects, items)
    got = {r["doc_id"]: r for r in queries.op2_decontaminate(spark, SF001).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        n, hit, ids = want.get(d, [(len(words(t)), 0, [])])[0]
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(ids), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert suspects


def test_nodes_stay_under_the_bound():
    rnd = random.Random(2)
    for text in ("", "a", "ab cd", " ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)), "é " * 50, "x" * 500):
        nodes = decontaminate.Scanner([("i", text)]).automaton.get_stats()["nodes_count"] if text else 0
        assert nodes <= decontaminate.WINDOW * (len(text.encode()) + 2) + 64
