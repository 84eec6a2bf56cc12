"""Op 10: counts against brute force, held-out accuracy of the classifier, edge rows."""

import random
import re
from collections import Counter

from conftest import SF01
from pacewise.llm import quality, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[k: k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if grams[tuple(w[k: k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_counts():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "b ", "é", " c ", "\n", "\t", "#", "|>", "\x1c", " ", "x y z ", "\x0b"]) for _ in range(rnd.randrange(80)))
        assert quality.measured(text)[0] == brute(text)
    for text in ("", "a a a a a", "one", "\n\n\n", "x " * 5000):
        assert quality.measured(text)[0] == brute(text)


def test_held_out_accuracy(spark):
    """Trained on half of the labels, nearly all of the other half come out right."""
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    truth = {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 2 = 1").collect()}
    rows = [r for r in quality.rules(docs, model).collect() if r["doc_id"] in truth and not r["base_failed"]]
    right = sum((r["quality_probability"] >= quality.THRESHOLD) == truth[r["doc_id"]] for r in rows)
    assert len(rows) > 100 and right >= 0.97 * len(rows)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = queries.op10_quality(spark, SF01).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["quality_probability"] >= quality.THRESHOLD)


def test_edges(spark):
    schema = "doc_id int, text string, KEPT string"
    fine = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([(1, None, ""), (2, "", ""), (3, fine, ""), (3, fine, ""), (None, "a b " * 300, "")], schema)
    labels = spark.createDataFrame([], "doc_id int, quality int, toxic int")
    model = quality.train(df, labels)
    assert model is None
    out = quality.rules(df, model)
    assert [c.lower() for c in out.columns].count("kept") == 1
    assert sorted((r["n_words"], r["base_failed"], r["kept"]) for r in out.collect()) == [
        (0, True, False), (0, True, False), (60, False, True), (60, False, True), (600, True, False)]
    assert quality.rules(df.limit(0), model).collect() == []
    odd = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (1, 1, 0), (9, None, 0)], "doc_id int, quality int, toxic int")
    quality.train(df, odd)


def test_same_rows_same_model(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    a, b = quality.train(docs, labels), quality.train(docs.repartition(7), labels.repartition(5))
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)
