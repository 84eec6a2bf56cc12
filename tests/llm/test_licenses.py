"""Op 8 against exact containment in Python, and edge rows."""

import random
import re

import pytest
from conftest import SF01
from pacewise.llm import licenses, queries

WORD = re.compile("[0-9a-zß-öø-ɏ]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    return [tuple(w[k: k + 5]) for k in range(len(w) - 4)]


def template_list(templates, needed):
    """(license, shingles, groups of which a stretch must hold one each) of every template."""
    out = []
    for name, bodies in templates.items():
        for body in bodies:
            t, w = shingles(body), WORD.findall(body.lower())
            groups = [{x} for x in shingles(needed.get(name))]
            if len(t) <= licenses.SHORT:
                groups = [set(t[max(0, k - 4): k + 1]) for k, x in enumerate(w) if re.fullmatch("v?[0-9]+", x)]
            out.append((name, t, groups))
    return out


ALL = template_list(licenses.all_templates(), licenses.NEEDED)
RIVALS = {(x, y) for x, s, _ in ALL for y, t, _ in ALL if x != y and len(set(s) & set(t)) >= licenses.RIVAL * len(set(s))}


def brute(text, templates=None):
    s, best = shingles(text), {}
    for name, t, groups in ALL if templates is None else templates:
        whole, reach = set(t), len(t) + max(2, len(t) // 4)
        for k, x in enumerate(s):
            if x in whole:
                stretch = set(s[k: k + reach])
                c = len(whole & stretch) / len(whole)
                if c >= 0.8 and all(g & stretch for g in groups):
                    size = min(reach + 4, len(s) + 4 - k)
                    best[name] = max(best.get(name, (0,)), (c, -k, -size, len(whole & stretch), len(t)))
    def beaten(x):
        c, k, _, n, size = best[x]
        return any((x, y) in RIVALS and -k < -k2 + size2 and -k2 < -k + size and (n2, c2) > (n, c) for y, (c2, k2, _, n2, size2) in best.items())
    return sorted((name, -k, round(c, 9)) for name, (c, k, *_) in best.items() if not beaten(name))


def found(rows):
    return [sorted((m["license"], m["start"], round(m["containment"], 9)) for m in r["licenses"]) for r in rows]


def test_notices_inside_texts(spark):
    rnd, texts = random.Random(4), []
    noise = lambda: " ".join(rnd.choice(["the", "of", "Är", "x1", "License,", "under"]) for _ in range(rnd.randint(0, 40)))
    for bodies in licenses.all_templates().values():
        for body in bodies:
            w = body.split()
            if len(w) > 2 * licenses.SHORT:
                continue  # whole texts: below
            texts += [f"{noise()} {body} {noise()}", body.upper(), f"{noise()}\n# {body.replace(' ', '  ')}\n",
                      " ".join(w[: len(w) // 2]), " ".join(x if k != len(w) // 2 else "zzz" for k, x in enumerate(w)),
                      f"{body} {noise()} {body}"]
    df = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "id int, text string, Licenses int").coalesce(1)
    rows = licenses.scan(df).orderBy("id").collect()
    assert found(rows) == [brute(t) for t in texts]
    assert all(m["start"] + m["n_words"] <= len(WORD.findall(r["text"].lower())) for r in rows for m in r["licenses"])


def test_edges(spark):
    schema = "text string"
    df = spark.createDataFrame([(None,), ("",), ("four words are few",), ("Released under the MIT License.",)] * 2, schema)
    assert sorted(map(len, found(licenses.scan(df).collect()))) == [0] * 6 + [1] * 2
    assert licenses.scan(spark.createDataFrame([], schema)).collect() == []
    assert licenses.scan(df, templates={}).where("size(licenses) > 0").count() == 0


def test_query_finds_every_notice(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op8_licenses(spark, SF01).collect()}
    assert got.keys() == docs.keys()
    assert {d: r["licenses"] for d, r in got.items()} == {d: ",".join(x[0] for x in brute(t)) for d, t in docs.items()}
    assert any(r["n_licenses"] for r in got.values())


def test_versions_families_and_whole_texts(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License"
    work = "This work is licensed under the GNU {} Public License, version {}."
    cases = {(kind, v): name for kind, v, name in [("General", "3", "GPL-3.0"), ("General", "2", "GPL-2.0"), ("Lesser General", "3", "LGPL-3.0"),
                                                   ("Lesser General", "2.1", "LGPL-2.1"), ("Affero General", "3", "AGPL-3.0"), ("General", "9", None)]}
    texts = [(f"some words {form.format(*at)} and others", {name} - {None}) for at, name in cases.items() for form in (gpl, work)]
    texts += [(f"{work.format('General', '2')} {work.format('General', '3')}", {"GPL-2.0", "GPL-3.0"}),
              ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}), ("Licensed under CC BY-SA 4.0.", {"CC-BY-SA-4.0"}), ("Licensed under CC BY-NC 3.0.", {"CC-BY-NC-3.0"}),
              ("Distributed under the MIT License.", {"MIT"}), ("Released under the ISC License.", {"ISC"}), ("Licensed under CC0 1.0.", {"CC0-1.0"}),
              ("made available under the terms of the Eclipse Public License 2.0", {"EPL-2.0"})]
    for name in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0"):
        whole = licenses.all_templates()[name][-1]
        w = whole.split()
        texts += [(whole, {name}), (" ".join(["before"] * 9 + w[len(w) // 20: -len(w) // 20]), {name})]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "id int, text string").repartition(8)
    rows = licenses.scan(df).orderBy("id").collect()
    got = [{m["license"] for m in r["licenses"]} for r in rows]
    assert [(t[:60], g) for (t, _), g in zip(texts, got, strict=True)] == [(t[:60], want) for t, want in texts]


def test_whole_texts_and_much_repeated_notices(spark):
    known = {name: licenses.all_templates()[name] for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0")}
    texts = [f"a b {known['MIT'][-1]} c d", known["BSD-3-Clause"][-1], known["BSD-2-Clause"][-1] + known["ISC"][-1],
             " ".join(w for k, w in enumerate(known["Apache-2.0"][-1].split()) if k % 60), known["Apache-2.0"][-1][3000:]]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), templates=known).orderBy("id").collect()
    listed = template_list(known, {})
    assert [[x[0] for x in f] for f in found(rows)] == [[x[0] for x in brute(t, listed)] for t in texts]
    assert found(rows)[:3] == [brute(t, listed) for t in texts[:3]]
    many = "Licensed under CC BY 4.0. " * 40_000  # linear in the occurrences
    df = spark.createDataFrame([(1, many), (2, many), (3, None)], "id int, text string")
    assert found(licenses.scan(df).orderBy("id").collect()) == [[("CC-BY-4.0", 0, 1.0)]] * 2 + [[]]


def test_a_list_of_200_000_shingles(spark):
    rnd = random.Random(8)
    known = {f"L{k}": [" ".join(f"w{rnd.randrange(5000)}" for _ in range(1004))] for k in range(200)}
    texts = [f"before {known[f'L{k}'][0]} after" for k in range(0, 200, 9)] + [known["L3"][0][:2000]]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), templates=known).orderBy("id").collect()
    assert found(rows) == [[(f"L{k}", 1, 1.0)] for k in range(0, 200, 9)] + [[]]


def test_native_plan(spark):
    plan = queries.op8_licenses(spark, SF01)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([("x",)], "text string"), templates={"short": ["only four words here"]})
