"""Op 5 against a brute-force version, and edge rows."""

import random

from conftest import SF001
from pacewise.llm import linededup, queries


def brute(docs):
    """docs: (id, text) with distinct ids, or equal rows; ids order with null last."""
    order = sorted({d for d in docs}, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    first, out = {}, {}
    for place, (d, t) in enumerate(order):
        lines = t.split("\n") if t else []
        for k in range(len(lines) - 2):
            first.setdefault(tuple(lines[k: k + 3]), (d, k))
    for d, t in order:
        lines = t.split("\n") if t else []
        gone = {k + j for k in range(len(lines) - 2) for j in range(3)
                if any(x.strip(" \t\n\x0b\x0c\r") for x in lines[k: k + 3]) and first[tuple(lines[k: k + 3])] != (d, k)}
        out[d, t] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t)
    return sorted((d, *out[d, t]) for d, t in docs if d is not None) + [(d, *out[d, t]) for d, t in docs if d is None]


def run(spark, docs):
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, N_Lines string")
    got = [(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in linededup.dedup_lines(df).collect()]
    return sorted(x for x in got if x[0] is not None) + [x for x in got if x[0] is None]


def test_brute_force(spark):
    rnd = random.Random(5)
    docs = [(k, "\n".join(rnd.choice(["a", "b", "c d", "", " "]) for _ in range(rnd.randint(1, 40)))) for k in range(40)]
    docs += [(50, "x\ny\nz"), (51, "0\nx\ny\nz\n1"), (52, "x\ny"), (53, ""), (54, "\n\n\n\n"), (55, "q\nq\nq\nq\nq"),
             (None, "x\ny\nz"), (56, "\n".join(f"line {k}" for k in range(3000))), (57, "\n".join(f"line {k}" for k in range(5, 2990)))]
    assert run(spark, docs) == brute(docs)


def test_nulls_repeats_and_no_rows(spark):
    assert run(spark, [(1, None), (2, None)]) == [(1, 0, 0, None), (2, 0, 0, None)]
    same = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")]
    assert run(spark, same) == [(1, 3, 0, "a\nb\nc"), (1, 3, 0, "a\nb\nc"), (2, 4, 3, "d")]
    assert run(spark, []) == []


def test_texts_of_one_id(spark):
    shared = "a\nb\nc"
    for d in (None, 7):
        docs = [(d, shared), (d, shared + "\nmore"), (d, "0\n" + shared), (d, "9\n8\n" + shared + "\n7")]
        got = run(spark, docs + [(8, "other\n" + shared)])
        kept = [r for r in got if r[0] == d]
        assert sorted(r[2] for r in kept) == ([3, 3, 3, 3] if d is None else [0, 3, 3, 3])
        assert [r[2] for r in got if r[0] == 8] == ([0] if d is None else [3])
        words = sorted(w for r in kept for w in (r[3] or "").split("\n") if w in "0 9 8 7 more".split())
        assert words == ["0", "7", "8", "9", "more"]  # no line outside the repeats goes
    assert sorted(r[2] for r in run(spark, [(None, shared), (None, shared), (None, shared + "\nz")])) in ([0, 0, 3], [0, 3, 3])


def test_query_counts(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {d: (n, g) for d, n, g, _ in brute(docs)}
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in queries.op5_linededup(spark, SF001).collect()}
    assert got == want and any(g for _, g in want.values())
