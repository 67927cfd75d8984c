"""Licence scans against a dictionary version."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from pointloom.llm import licences as L


def pieces(text):
    lines = []
    for line in re.split(r"\r?\n", text):
        line = line.strip()
        line = re.sub(r"^(/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|>+)", "", line).strip()
        lines.append(re.sub(r"(\*+/|-->)$", "", line).strip())
    joined, last = "", "\n"
    for line in lines:  # lines of one paragraph are joined
        joined += ("\n" if not line or last in ("", "\n") else " ") + line
        last = line
    out = []
    for part in [*lines, *joined.split("\n")]:
        out += re.split(r"(?<=[.!?;])\s+(?![0-9])", part)
    return {p.strip() for p in out if p.strip()}


def brute(rows, licence_file):
    """rows: (key, path, text) -> {key: (licence, score, sentence, inherited, inherited_from)}; frequencies of all terms."""
    words = lambda s: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", s.lower())
    df = Counter(t for _, _, x in rows for t in set(words(x or "")))
    idf = lambda t: math.log((1 + len(rows)) / (1 + df[t])) + 1

    def vector(s):
        v = {t: n * idf(t) for t, n in Counter(words(s)).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    templates = [(name, *vector(s)) for name, s in L.TEMPLATES]
    own, dirs = {}, {}
    for key, path, text in rows:
        best = None
        for s in pieces(text or ""):
            if re.search(L.CUE, s) and not re.search(L.DENIED, s):
                v, norm = vector(s)
                by = {}
                for name, t, tn in templates:
                    by[name] = max(by.get(name, 0), round(sum(x * t.get(w, 0) for w, x in v.items()) / tn / norm, 6))
                score = max(by.values())
                if score >= L.LEAST and list(by.values()).count(score) == 1 and by[""] < score:
                    one = (score, max(by, key=by.get), s)
                    best = max(best, one) if best else one
        own[key] = best
        if own[key] and path is not None and licence_file(path, text):
            d = path.rpartition("/")[0]
            dirs[d] = min(dirs.get(d, (9, "", "")), (-own[key][0], path, own[key][1]))
    out = {}
    for key, path, _ in rows:
        d, found = (path or "").rpartition("/")[0], None
        while path is not None:
            if d in dirs:
                found = dirs[d]
                break
            if not d:
                break
            d = d.rpartition("/")[0]
        score, name, sentence = own[key] or (None, None, None)
        out[key] = (name, score, sentence, found and found[2], found and found[1])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for k, (name, score, *rest) in want.items():
        assert got[k][0] == name and list(got[k][2:]) == rest, (k, got[k], want[k])
        assert (score is None) == (got[k][1] is None) and (score is None or abs(score - got[k][1]) < 2e-6)


def test_small_tree(spark):
    mit, apache = "Released under the MIT License.", L.TEMPLATES[0][1]
    rows = [
        (1, "LICENSE", f"{mit} Copyright me."), (2, "a/x.py", "plain words only"), (3, "a/b/COPYING", apache), (4, "a/b/c/y.py", None),
        (5, "a/b/z.py", f"code\n{mit}\nmore"), (6, "d/e/w.py", ""), (7, None, "nothing"), (8, "a/b/LICENSE.md", f"intro\nLicensed under CC BY-NC 4.0."),
        (9, "q.py", "we talk about a licence in general terms, nothing else"), (10, "a/b/c/y.py", "word " * 3000 + apache),
        (10, "a/b/c/y.py", "word " * 3000 + apache),
    ]
    df = spark.createDataFrame([(*r, "old") for r in rows], "key int, path string, text string, final string")
    out = L.scan(df, F.col("path")).collect()
    name = lambda p, _: re.match(L.LICENCE_FILE, p.rpartition("/")[2]) is not None
    same({r.key: (r.licence, r.score, r.sentence, r.inherited, r.inherited_from) for r in out}, brute(rows, name))
    by = {r.key: r.final for r in out}
    assert by[2] == "MIT" and by[4] in ("Apache-2.0", "CC-BY-NC-4.0") and by[7] is None and len(out) == 11
    assert L.scan(df.limit(0), F.col("path")).count() == 0


HEADERS = {
    "spdx": ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]),
    "spdx2": ("# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) OR Apache-2.0\nx = 1", ["Apache-2.0", "GPL-2.0"]),
    "gpl3": (
        "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */", ["GPL-3.0"],
    ),
    "lgpl": (
        "; This library is free software; you can redistribute it and/or\n; modify it under the terms of the GNU Lesser General Public\n; License as published by the Free Software Foundation; "
        "either\n; version 2.1 of the License, or (at your option) any later version.", ["LGPL-2.1"],
    ),
    "title3": ("GNU GENERAL PUBLIC LICENSE\nVersion 3\n\nother words", ["GPL-3.0"]),
    "title2": ("GNU GENERAL PUBLIC LICENSE\nVersion 2\n\nother words", ["GPL-2.0"]),
    "apache": (
        "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n", ["Apache-2.0"],
    ),
    "mpl": ("// This Source Code Form is subject to the terms of the Mozilla\n// Public License, v. 2.0.\n", ["MPL-2.0"]),
    "bsd": (
        "<!-- Redistribution and use in source and binary forms, with or without\n modification, are permitted provided that the following conditions\n are met: -->", ["BSD-3-Clause"],
    ),
    "by": ("Released under the MIT License by our project.", ["MIT"]),
    "both": ("Released under the MIT License.\n\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]),
    "bare": ("GNU General Public License", None),
    "denied": ("This is not released under the MIT License.", None),
    "talk": ("We talk about a licence in general terms.", None),
}


def test_usual_headers_whatever_the_number_of_files(spark):
    for more in (30, 3000):
        filler = [(f"f{i}", f"plain words by our project number {i} for all who read it in this or any other place\nand more of the same") for i in range(more)]
        df = spark.createDataFrame([*((k, t) for k, (t, _) in HEADERS.items()), *filler], "key string, text string")
        out = {r.key: r.licences for r in L.scan(df, F.concat(F.lit("x/"), "key")).where("licences is not null").collect()}
        assert out == {k: want for k, (_, want) in HEADERS.items() if want}


def test_query_is_native_and_right(spark, sf_dir):
    from pointloom.llm.queries import ALL

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.path, r.text) for r in docs.withColumn("path", L.document_path(F.col("source"), F.col("lang"), F.col("doc_id"))).collect()]
    out = ALL["op4_licences"](spark, sf_dir)
    same(
        {r.doc_id: (r.licence, r.score, r.sentence, r.inherited, r.inherited_from) for r in out.collect()},
        brute(rows, lambda _, t: len(re.findall(r"\S+", t or "")) <= 60),
    )
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
