"""Op 11 against a plain scoring of every document, and edge rows."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from pacewise.llm import lexical, queries
from pacewise.session import fresh_dir

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("BLOCK", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    held = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scored = []
        for d, c in held:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * n_docs // n_terms if n_terms else 0)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:20])]
    return sorted(out, key=str)


def compare(spark, docs, items, parts=4, block_bytes=lexical.BLOCK_BYTES, part_bytes=lexical.PART_BYTES):
    path = fresh_dir(spark, "test-index")
    lexical.build_index(spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS).repartition(parts), path, block_bytes=block_bytes)
    got = lexical.search(spark, path, spark.createDataFrame(items, ITEMS), part_bytes=part_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, items)


def sample(n=300, seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本"]
    pick = lambda k: " ".join(vocabulary[min(int(rnd.expovariate(0.12)), 61)] + rnd.choice(["", ",", ".", "-"]) for _ in range(k))
    docs = [(i, pick(rnd.choice([0, 1, 5, 40, 200]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "?!"), (n + 3, docs[7][1]), (7, "W0 w1 W2"), (None, "w0 w1 w59"), (None, "w0 w1 w59"),
             (n + 4, docs[3][1]), (n + 5, "w1 " * 500)]
    items = [(1, pick(30)), (2, pick(3)), (3, "w0"), (4, None), (5, ""), (6, "absent words"), (7, "w0 w0 w59 W59"), (7, "w0 w0 w59 W59"),
             (8, pick(200)), (None, "w59 É"), (9, "日本,é"), (1, "w2")]
    return docs, items


def test_equals_brute_force(spark):
    compare(spark, *sample())


def test_small_blocks_and_parts(spark):
    docs, items = sample(200, 9)
    compare(spark, docs, items, parts=2, block_bytes=3000, part_bytes=400)


def test_skipping_is_exact():
    """Blocks of many documents with lists of all lengths: the loop skips and still finds the same."""
    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(1)
    n, rows = 6000, []
    for t, share in enumerate([0.9, 0.7, 0.5, 0.3, 0.1, 0.03, 0.01, 0.002]):
        docs = np.flatnonzero(rnd.random(n) < share)
        rows.append({"block": 0, "term": str(t), "docs": docs.tolist(), "counts": rnd.integers(1, 9, len(docs)).tolist(), "ids": None})
    rows.append({"block": 0, "term": None, "docs": rnd.integers(5, 500, n).tolist(), "counts": None, "ids": rnd.permutation(n).tolist()})
    block = lexical._Block(pa.Table.from_pylist(rows, lexical._INDEX), {str(t): (t, 200 + 900 * t) for t in range(8)}, n, 250 * n)
    for _ in range(40):
        asked = [(int(t), int(rnd.integers(1, 4))) for t in rnd.choice(8, rnd.integers(1, 9), replace=False)]
        total = np.zeros(n, np.int64)
        for t, times in asked:
            j = block.place[t]
            total[block.docs[block.edges[j]:block.edges[j + 1]]] += times * block.scores[block.edges[j]:block.edges[j + 1]]
        order = np.lexsort((block.ids, -total))[:20]
        order = order[total[order] > 0]
        docs, scores = block.best(asked)
        assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()


def test_very_long_text(spark):
    compare(spark, [(1, "w1 w2 " * 800_000), (2, "w1 w3"), (3, "x" * 100_000)], [(1, "w1 w2 w3")], parts=1)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a b")], []), ([(1, None)], [(1, "a")]), ([], [])])
def test_empty(spark, docs, items):
    compare(spark, docs, items, parts=1)


def test_query(spark):
    from conftest import SF001
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = [tuple(r) for r in queries.QUERIES["op11_search"](spark, SF001).collect()]
    assert sorted(got, key=str) == brute(docs, items)
