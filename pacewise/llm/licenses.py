"""Op 8: license notices, found by MinHash bands over overlapping windows and verified exactly.

Words are runs of letters and digits, lower-cased; a shingle is five consecutive words. A window is
two neighbouring shingles (six words, one for every word of the text; at either end also the one shingle alone).
Each of ``BANDS`` bands keeps the window's smaller shingle under its own permutation (xor with a constant).
The band table has a row for every template shingle with the bands whose windows keep it; a shingle that the
same band keeps in a window of the text retrieves the template. A shared shingle lies in two windows, and a
band loses it only if both its neighbours are smaller (1/3), so one shared shingle is retrieved with
probability 1 - 3**-BANDS or more, here 0.998; longer notices share many.

Verification, of the retrieved (text, template) pairs only: some stretch of the text, a quarter longer than the
template, holds 0.8 or more of its distinct shingles; of a notice also one around each version number. Which
shingles a stretch holds is a running sum: an occurrence counts for the stretches that begin after the same
shingle's last occurrence before it, and reach it. So a text is sorted by position and read once, whatever its
length and however often it repeats a notice. Templates of every length take the same way. Licenses
whose templates hold much of each other compete: of two found in one stretch the one that shares more
shingles stays (the better contained among equals).

Templates are ``TEMPLATES``, further notices by version and family (``_notices``) and the whole texts in
``license_texts``: Apache-2.0, BSD-2/3-Clause, GPL-2.0/3.0, ISC, LGPL-2.1/3.0, MIT, MPL-2.0.

One join probes the band table with every word's shingle and brings the shared shingles of the pairs along;
the table is broadcast up to ``BROADCAST_BYTES`` of template text, beyond which Spark joins it as it sees fit.
Texts are known by two hashes, so what is shuffled is the shared shingles (once for all copies of a text) and
the columns asked for of the rows. One key's rows are those of one text.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.common import without

SHINGLE = 5
CONTAINED = 0.8
BANDS = 6
BROADCAST_BYTES = 4 << 20   # of template texts; about 700,000 shingles, some 50 MB as a hash table
# Odd-looking constants of the permutations (hexadecimal digits of pi).
PERMUTATIONS = (0x243F6A8885A308D3, 0x13198A2E03707344, -0x5BF6C7DD660CE230, 0x082EFA98EC4E6C89,
                0x452821E638D01377, -0x41AB9930CB16F394)

SHORT = 100          # shingles; templates up to this are notices, whose version numbers must be found
RIVAL = 0.5          # share of a template's shingles that another license's template holds

# Short notices as public licenses ask for them, and the first sentence of longer texts.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


# Further notices, by version and family.
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_KINDS = {"4.0": "International", "3.0": "Unported", "2.0": "Generic"}
_GNU = {"GPL": ("General", "program", "1.0 2.0 3.0"), "LGPL": ("Lesser General", "library", "2.1 3.0"),
        "AGPL": ("Affero General", "program", "3.0")}


def _notices() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {
        "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
        "MIT": ["Licensed under the MIT License.", "Distributed under the MIT License."],
        "BSD": ["Released under the BSD License.", "Licensed under the BSD License.", "Distributed under the BSD License."],
        "ISC": ["Released under the ISC License.", "Licensed under the ISC License.", "Distributed under the ISC License."],
        "LGPL-2.0": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
                     "General Public License as published by the Free Software Foundation; either version 2 of the License"],
        "MPL-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1"],
        "EPL-1.0": ["made available under the terms of the Eclipse Public License v1.0"],
        "EPL-2.0": ["made available under the terms of the Eclipse Public License 2.0",
                    "made available under the terms of the Eclipse Public License v. 2.0"],
        "CC0-1.0": ["Licensed under CC0 1.0.", "This work is licensed under a Creative Commons CC0 1.0 Universal License",
                    "Creative Commons Legal Code CC0 1.0 Universal",
                    "has waived all copyright and related or neighboring rights to this work"],
    }
    for code, kind in _CC.items():
        for version, scope in _CC_KINDS.items():
            for notice in (f"Licensed under CC {code} {version}.", f"This work is licensed under a Creative Commons {kind} {version} {scope} License"):
                name = f"CC-{code}-{version}"
                if notice not in TEMPLATES.get(name, []):
                    found.setdefault(name, []).append(notice)
    for code, (kind, thing, versions) in _GNU.items():
        for version in versions.split():
            name, number = f"{code}-{version}", version.removesuffix(".0")
            for work in ("program", thing):
                for notice in (f"This work is licensed under the GNU {kind} Public License, version {number}.",
                               f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
                               f"License as published by the Free Software Foundation, either version {number} of the License"):
                    if notice not in [*TEMPLATES.get(name, []), *found.get(name, [])]:
                        found.setdefault(name, []).append(notice)
    return found


# Words of which five in a row must be in the stretch, where another license's whole text is nearly the same.
NEEDED = {"GPL-3.0": "Use with the GNU Affero", "LGPL-2.1": "the GNU Lesser General Public"}


@cache
def all_templates() -> dict[str, list[str]]:
    """``TEMPLATES``, the further notices and the whole texts in ``license_texts``."""
    found = {name: list(bodies) for name, bodies in TEMPLATES.items()}
    for name, bodies in _notices().items():
        found.setdefault(name, []).extend(bodies)
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        found.setdefault(path.stem, []).append(path.read_text(encoding="utf-8"))
    return found


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^0-9a-zß-öø-ɏ]+"), "")


def _plain_words(text: str) -> list[str]:
    return re.findall("[0-9a-zß-öø-ɏ]+", text.lower())


def _hashes(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__w``, the words' hashes, and ``__s``, those of the shingles in text order (two references each keep Spark from inlining)."""
    hashed = df.withColumn("__w", F.transform(words(F.col(f"`{text}`")), lambda w: F.xxhash64(w)))
    shingles = F.transform(F.sequence(F.lit(0), F.size("__w") - SHINGLE),
                           lambda i: F.xxhash64(*[F.col("__w")[i + k] for k in range(SHINGLE)]))
    return hashed.withColumn("__s", F.when(F.size("__w") >= SHINGLE, shingles).otherwise(F.array().cast("array<bigint>")))


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """A row for every shingle of ``__s``: ``columns``, its position, itself and its neighbours (null beyond the ends)."""
    near = F.transform("__s", lambda s, i: F.struct(F.get("__s", i - 1).alias("before"), s.alias("key"), F.get("__s", i + 1).alias("after")))
    return df.select(*columns, F.posexplode(near).alias("pos", "__at")).select(*columns, "pos", "__at.before", "__at.key", "__at.after")


def _kept_by() -> Column:
    """Bit set of the bands that keep ``key`` in a window with either neighbour."""
    return F.expr(" | ".join(f"if((key ^ {p}L) <= coalesce(before ^ {p}L, key ^ {p}L) OR (key ^ {p}L) <= coalesce(after ^ {p}L, key ^ {p}L), {1 << b}, 0)"
                             for b, p in enumerate(PERMUTATIONS[:BANDS])))


def band_table(df: DataFrame, templates: dict[str, list[str]], needed: dict[str, str]) -> DataFrame:
    """A row for each distinct shingle of each template: its bands, and the groups it is in. A stretch must
    hold a shingle of every group: the shingles around one version number of a notice, or one of ``needed``.

    ``own`` is 0 for needed shingles that are not the template's.
    """
    rows = []
    for k, (name, body) in enumerate((n, b) for n in sorted(templates) for b in templates[n]):
        notice = len(_plain_words(body)) < SHORT + SHINGLE
        rows.append((k, name, body, notice, None if notice else needed.get(name)))
    # which templates are notices is known here: a filter on it would be pushed below the hashes and compute them anew
    listed = _hashes(df.sparkSession.createDataFrame(rows, "template int, license string, body string, notice boolean, must string"), "body")
    listed = listed.withColumn("number", F.transform(words(F.col("body")), lambda w: F.col("notice") & w.rlike("^v?[0-9]+$")))
    must = _hashes(listed.select("template", "must"), "must").select("template", F.posexplode("__s").alias("g", "key"))
    n_must = must.groupBy("template").agg(F.count("*").cast("int").alias("n_must"))
    meta = listed.select("template", "license", F.size("__s").alias("size"), F.size(F.array_distinct("__s")).alias("n_distinct"),
                         F.size(F.filter("number", lambda x: x)).alias("n_numbers")).join(n_must, "template", "left")
    inside = F.filter(F.sequence(F.col("pos"), F.col("pos") + SHINGLE - 1), lambda k: F.get("number", k))
    own = _spread(listed, "template", "number").select("template", "key", F.lit(1).alias("own"), _kept_by().alias("bands"), inside.alias("groups"))
    also = must.select("template", "key", F.lit(0).alias("own"), F.lit(0).alias("bands"), F.array(-1 - F.col("g")).alias("groups"))
    keys = own.unionByName(also).groupBy("template", "key").agg(
        F.max("own").alias("own"), F.bit_or("bands").alias("bands"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("groups")))).alias("groups"))
    return keys.join(meta, "template").select("template", "license", "size", "n_distinct", "key", "own", "bands", "groups",
                                              (F.col("n_numbers") + F.coalesce("n_must", F.lit(0))).alias("n_groups"))


def _rivals(table: DataFrame) -> DataFrame:
    """By license, the others whose templates hold so much of one of its templates that they look like it."""
    x = table.where("own = 1").select("template", "license", "n_distinct", "key")
    y = x.select(F.col("template").alias("other"), F.col("license").alias("rival"), "key")
    pairs = x.join(y, "key").where("license <> rival").groupBy("template", "other", "license", "rival", "n_distinct").count()
    return pairs.where(F.col("count") >= RIVAL * F.col("n_distinct")).groupBy("license").agg(F.collect_set("rival").alias("rivals"))


TEXT = ("__h1", "__h2")      # two hashes of a text
PAIR = (*TEXT, "template", "license", "size", "n_distinct", "n_groups", "__n")


def _retrieved(texts: DataFrame, text: str, table: DataFrame) -> DataFrame:
    """The shared shingles of every text and each template that a band retrieves for it."""
    hashed = _hashes(texts, text).withColumn("__n", F.size("__w"))
    shared = _spread(hashed, *TEXT, "__n").join(table, "key").withColumn("hit", F.col("bands").bitwiseAND(_kept_by()) != 0)
    once = shared.groupBy(*PAIR, "pos", "key", "own", "groups").agg(F.max("hit").alias("hit"))  # copies of a text are one
    return once.withColumn("found", F.max("hit").over(Window.partitionBy(*TEXT, "template"))).where("found")


def _verified(shared: DataFrame) -> DataFrame:
    """The best stretch of each license in each text: the one contained best, the earliest and then the shortest among equals."""
    pair = Window.partitionBy(*TEXT, "template")
    reach = F.expr("size + greatest(2, size div 4)")
    units = F.expr("""concat(array(struct(key AS unit, own AS shared, 0 AS held)),
                             transform(groups, g -> struct(cast(g AS bigint) AS unit, 0 AS shared, 1 AS held)))""")
    held = shared.select(*PAIR, "pos", F.inline(units))
    last = F.lag("pos").over(Window.partitionBy(*TEXT, "template", "held", "unit").orderBy("pos"))
    held = held.withColumn("first", F.greatest(F.coalesce(last + 1, F.lit(0)), F.col("pos") - reach + 1))
    steps = held.select(*PAIR, F.inline(F.expr("""array(struct(first AS at, shared, held, 0 AS begins),
                                                        struct(pos + 1 AS at, -shared AS shared, -held AS held, 0 AS begins),
                                                        struct(pos AS at, 0 AS shared, 0 AS held, shared AS begins))""")))
    sums = steps.groupBy(*PAIR, "at").agg(F.sum("shared").alias("shared"), F.sum("held").alias("held"), F.max("begins").alias("begins"))
    upto = pair.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = sums.withColumn("shared", F.sum("shared").over(upto)).withColumn("held", F.sum("held").over(upto))
    held = held.where("begins = 1 AND held >= n_groups").withColumn("containment", F.col("shared") / F.col("n_distinct")).where(F.col("containment") >= CONTAINED)
    n_words = F.least(reach + SHINGLE - 1, F.col("__n") - F.col("at"))
    return held.groupBy(*TEXT, "license").agg(F.max(F.struct("containment", (-F.col("at")).alias("first"), (-n_words).alias("less"), "shared", "size")).alias("best"))


def scan(df: DataFrame, text: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Adds ``licenses``: sorted array of (license, start, n_words, containment), one for each
    license found; start is the first word of its best stretch (the earliest among equals).

    Null texts and texts under five words have none; an empty template list finds none; a template under five
    words is refused. All rows stay; rows of equal text have equal licenses. An input column named ``licenses`` gives way.
    """
    kept = without(df, "licenses")
    kind = "array<struct<license:string,start:int,n_words:int,containment:double>>"
    known, needed = (all_templates(), NEEDED) if templates is None else (templates, {})
    bodies = [b for bs in known.values() for b in bs]
    if not bodies:
        return kept.withColumn("licenses", F.array().cast(kind))
    if any(len(_plain_words(b)) < SHINGLE for b in bodies):
        raise ValueError(f"a template needs {SHINGLE} words or more")

    body = F.col(f"`{text}`")
    hashes = [F.when(body.isNotNull(), F.xxhash64(*seed, body)).alias(h) for h, seed in zip(TEXT, ([], [F.lit(1)]), strict=True)]
    table = band_table(kept, known, needed)
    probed = F.broadcast(table) if sum(map(len, bodies)) <= BROADCAST_BYTES else table
    found = _verified(_retrieved(kept.select(*hashes, body.alias("body")), "body", probed)).join(_rivals(table), "license", "left")
    match = F.struct("license", (-F.col("best.first")).alias("start"), (-F.col("best.less")).alias("n_words"), "best.containment", "best.shared", "best.size",
                     F.coalesce("rivals", F.array().cast("array<string>")).alias("rivals"))
    found = found.groupBy(*TEXT).agg(F.array_sort(F.collect_list(match)).alias("__m"))  # one of each license at most

    def beaten(x: Column, y: Column) -> Column:
        """Whether y, of a license much like that of x, shares more of the same stretch."""
        same = (x["start"] < y["start"] + y["size"]) & (y["start"] < x["start"] + x["size"])
        more = (y["shared"] > x["shared"]) | (y["shared"] == x["shared"]) & (y["containment"] > x["containment"])
        return F.array_contains(x["rivals"], y["license"]) & same & more

    left = F.filter("__m", lambda x: ~F.exists("__m", lambda y: beaten(x, y)))
    plain = F.transform(left, lambda m: F.struct(*[m[c].alias(c) for c in ("license", "start", "n_words", "containment")]))
    found = found.select(*TEXT, plain.cast(kind).alias("__licenses"))
    joined = kept.select("*", *hashes).join(found, list(TEXT), "left")
    return joined.withColumn("licenses", F.coalesce("__licenses", F.array().cast(kind))).drop(*TEXT, "__licenses")
