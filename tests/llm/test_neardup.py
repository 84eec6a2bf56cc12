"""Op 3 against brute force over all pairs, and edge rows."""

import random

import numpy as np
import pytest

from pacewise.llm import neardup, queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def near(x, y):
    """Similar by definition: aligned shingles of five words over all of both."""
    known = neardup._Hashes()
    a, b = (neardup.shingle_hashes((t or "").encode().split(), known).tolist() for t in (x, y))
    if not a or not b:
        return False
    c = lcs(a, b)
    return c / (len(a) + len(b) - c) >= 0.8 - 1e-9


def classes(docs):
    root = {d: d for d, _ in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (d, t) in enumerate(docs):
        for e, u in docs[:i]:
            if find(d) != find(e) and near(t, u):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return sorted((d, find(d)) for d, _ in docs)


def run(spark, docs):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, class_id string, keys int").repartition(3)
    return sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=str)


def words(rnd, n):
    return [f"w{rnd.randrange(2000)}" for _ in range(n)]


def edited(rnd, w, times):
    w = list(w)
    for _ in range(times):
        k = rnd.randrange(len(w))
        w[k: k + rnd.randrange(2)] = [f"e{rnd.randrange(10**6)}"] * rnd.randrange(2)
    return w


def test_alignment_is_the_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(400):
        a = [rnd.randrange(6) for _ in range(rnd.randrange(25))]
        b = [rnd.randrange(6) for _ in range(rnd.randrange(25))]
        assert neardup.aligned(a, b, 30) == lcs(a, b)
    for _ in range(200):
        a = [rnd.randrange(10**6) for _ in range(300)]
        b = edited(rnd, a, 12)
        assert neardup.aligned(a, b, 24) == lcs(a, b)


def test_labels_tell_repeats_apart():
    h = np.array([5, 7, 5, 5, 7], np.uint64)
    assert len(np.unique(neardup.labelled(h))) == 5
    assert np.array_equal(np.sort(neardup.labelled(h)), np.sort(neardup.labelled(h[::-1].copy())))


def test_groups_of_copies_against_all_pairs(spark):
    rnd, docs = random.Random(2), []
    for n in (6, 9, 20, 28, 33, 60, 150, 400):
        base = words(rnd, n)
        for k in range(6):
            docs.append(" ".join(edited(rnd, base, k * max(1, n // 120))))
        docs += [" ".join(base), "  ".join(base) + "\n"]
    chain = words(rnd, 200)
    for _ in range(12):  # each near the one before, the ends far from each other
        docs.append(" ".join(chain))
        chain = edited(rnd, chain, 4)
    passage = words(rnd, 60)
    docs += [" ".join(words(rnd, 30) + passage + words(rnd, 30)) for _ in range(25)]
    docs += ["a b c", "a b c", "a b d", "one", "one two three four five", "one two three four five six"]
    rnd.shuffle(docs)
    rows = list(enumerate(docs))
    assert run(spark, rows) == sorted(classes(rows), key=str)


@pytest.mark.parametrize("seed", [8, 9])
def test_members_between_near_and_far_keep_their_links(spark, seed):
    """One bucket for all: members of a class that only meet through others than the hub."""
    rnd, docs = random.Random(seed), []
    for _ in range(3):
        w = words(rnd, 120)
        for _ in range(9):
            docs.append(" ".join(w))
            w = edited(rnd, w, 2)
        for _ in range(20):
            docs.append(" ".join(edited(rnd, w, rnd.randrange(1, 7))))
    rnd.shuffle(docs)
    rows = list(enumerate(docs))
    bodies = spark.createDataFrame(rows, "doc bigint, text string").checkpoint()
    bucket = spark.createDataFrame([(1, d) for d, _ in rows], "key bigint, doc bigint")
    roots = {r["doc"]: r["root"] for r in neardup._roots(bucket, bodies).collect()}
    assert sorted((d, roots.get(d, d)) for d, _ in rows) == classes(rows)


def test_edges(spark):
    text = "the same five words and more"
    got = run(spark, [(4, None), (5, ""), (6, " \n"), (7, text), (7, text), (None, text), (9, text + " x"), (10, None)])
    assert got == sorted([(4, 4), (5, 5), (6, 6), (7, 7), (7, 7), (None, 7), (9, 9), (10, 10)], key=str) or near(text, text + " x")
    assert run(spark, []) == []
    long = " ".join(f"v{k}" for k in range(40_000))
    assert run(spark, [(1, long), (2, long + " tail"), (3, "other " + long)]) == [(1, 1), (2, 1), (3, 1)]


def test_components(spark):
    edges = [(k + 1, k) for k in range(30)] + [(100, 50), (100, 60), (70, 60)]
    got = {r["doc"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "doc bigint, hub bigint")).collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, 100: 50, 60: 50, 70: 50}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    known = neardup._Hashes()
    sets = {d: set(neardup.shingle_hashes(t.encode().split(), known).tolist()) for d, t in docs}
    got = dict(tuple(r) for r in queries.op3_neardup(spark, sf).collect())
    assert got.keys() == sets.keys()
    pairs = [(d, e) for d in sets for e in sets if e < d and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]) > 0]
    texts = dict(docs)
    assert pairs and all(got[d] == got[e] for d, e in pairs if near(texts[d], texts[e]))
    alone = set(sets) - {x for p in pairs for x in p}
    assert all(got[d] == d for d in alone)


def test_rows_of_one_id_and_of_none_are_linked_by_their_own_text(spark):
    """Two texts under one id, each near another document's; texts without an id near others."""
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    near = [t.replace("30", "changed", 1) for t in base]
    rows = [(7, base[0]), (7, base[1]), (8, near[0]), (9, near[1]), (None, base[2]), (3, near[2]), (None, base[3]), (None, near[3]), (None, "alone " * 9),
            (None, None), (5, ""), (7, base[0])]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted(((r["doc_id"], r["class_id"]) for r in got), key=str)
    assert found == sorted([(7, 7), (7, 7), (7, 7), (8, 7), (9, 7), (None, 3), (3, 3), (None, None), (None, None), (None, None), (None, None), (5, 5)], key=str)
