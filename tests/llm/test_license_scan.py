import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwork.llm import license_scan as S
from strandwork.llm.licence_texts import TEXTS

from .conftest import DOCS, doc, prose


def scanned(spark, rows):
    docs = spark.createDataFrame([doc(k, t) for k, (_, t) in enumerate(rows)], DOCS).withColumn("path", F.element_at(F.array(*[F.lit(p) for p, _ in rows]), F.col("doc_id").cast("int") + 1))
    return {r["path"]: r for r in S.scan(docs, F.col("path")).collect()}


def test_headers_files_and_inheritance(spark):
    mit = "The MIT License (MIT)\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rows = [
        ("a/LICENSE", mit), ("a/b/c/code.py", prose(1, 80)), ("a/b/other.py", prose(2, 50) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(3, 40)), ("a/b/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
        ("z/x.py", prose(5, 90)), ("a/y.py", "# SPDX-License-Identifier: MIT"), ("top.py", prose(6, 40)), ("a/bb/q.py", prose(7, 30)),
    ]
    got = scanned(spark, rows)
    assert got["a/LICENSE"]["licence"] == "MIT" and got["a/LICENSE"]["licence_file"]
    assert (got["a/b/c/code.py"]["licence"], got["a/b/c/code.py"]["inherited"], got["a/b/c/code.py"]["inherited_from"]) == (None, "GPL-3.0", "a/b")
    assert got["a/b/other.py"]["licence"] == "Apache-2.0" and got["a/b/other.py"]["line"] == 1 and got["a/b/other.py"]["inherited"] is None
    assert got["z/x.py"]["inherited"] is None and got["top.py"]["inherited"] is None
    assert got["a/y.py"]["licence"] == "MIT" and got["a/bb/q.py"]["inherited"] == "MIT"


def test_edge_cases(edge, nothing):
    got = S.scan(edge, F.col("source")).collect()
    assert len(got) == edge.count() and all(r["licence"] is None for r in got)
    assert S.scan(nothing, F.col("source")).count() == 0


def test_whole_licence_texts_and_statements_inside_lines(spark):
    from strandwork.llm.licence_texts import TEXTS

    rows = [(f"{n}/1.txt", t) for n, t in TEXTS] + [(f"{n}/2.txt", prose(k, 60)) for k, (n, _) in enumerate(TEXTS)]
    rows += [("wrapped/1.txt", " ".join(dict(TEXTS)["MIT"].replace("the copyright holders", "2024 Some Body").split())), ("wrapped/2.txt", prose(80, 30))]
    rows += [("x/1.txt", f"{prose(90, 40)} Licensed under the Apache License, Version 2.0. {prose(91, 40)}"), ("x/2.txt", prose(92, 40))]
    rows += [("x/3.txt", f"{prose(93, 40)} This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. {prose(94, 40)}")]
    got = scanned(spark, rows)
    for n, _ in TEXTS:
        one, two = got[f"{n}/1.txt"], got[f"{n}/2.txt"]
        assert (one["licence"], one["found"], one["licence_file"]) == (n, [n], True), one
        assert (two["licence"], two["inherited"], two["inherited_from"]) == (None, n, n), two
    assert got["wrapped/1.txt"]["licence"] == got["wrapped/2.txt"]["inherited"] == "MIT"
    assert (got["x/1.txt"]["found"], got["x/1.txt"]["licence_file"], got["x/2.txt"]["inherited"]) == (["Apache-2.0"], False, None)
    assert got["x/3.txt"]["found"] == ["CC-BY-SA-4.0"]


def test_one_word_many_times_is_no_statement(spark):
    assert scanned(spark, [("a/1.txt", f"{prose(1, 20)} mit, mit, mit, mit, mit, mit {prose(2, 20)}"), ("a/2.txt", prose(3, 20))])["a/1.txt"]["licence"] is None


def test_denied_statements_and_claims_of_rights(spark):
    from strandwork.llm.licence_texts import TEXTS

    rows = [
        ("a/1.txt", "This is not licensed under the MIT License."), ("b/1.txt", f"{prose(1, 30)} It was never released under the MIT License. {prose(2, 30)}"),
        ("c/1.txt", "Licensed under the Apache License, Version 2.0, not the MIT License."), ("d/1.txt", "Copyright (c) 2020 Some Body\nAll rights reserved.\n\n" + dict(TEXTS)["BSD-2-Clause"]),
        ("e/1.txt", f"{prose(3, 20)}\nAll rights reserved.\n{prose(4, 20)}"), ("f/1.txt", "All rights reserved.\n" + prose(5, 30) + "\nLicensed under the ISC License.\n"),
    ]
    got = scanned(spark, rows)
    assert got["a/1.txt"]["licence"] is None and got["b/1.txt"]["licence"] is None
    assert got["c/1.txt"]["found"] == ["Apache-2.0"]
    assert got["d/1.txt"]["licence"] == "BSD-2-Clause" and "Proprietary" not in got["d/1.txt"]["found"]
    assert got["e/1.txt"]["found"] == ["Proprietary"] and got["f/1.txt"]["found"] == ["ISC"]


def test_lines_against_plain_cosines(spark):
    """Best statement of every line by TF-IDF cosine worked out word by word, over the lines of all texts."""
    r = random.Random(3)
    statements = [t for _, t in S.TEMPLATES]
    lines = []
    for _ in range(300):
        w = r.choice(statements).split()
        for _ in range(r.randint(0, 4)):
            w.insert(r.randrange(len(w) + 1), prose(r.random(), 1)) if r.random() < 0.6 else w.pop(r.randrange(len(w))) if len(w) > 2 else None
        lines.append(" ".join(w))
    lines += [prose(k, 12) for k in range(300)]
    word = lambda t: re.sub(r"[!-/:-@\[-`{-~]", " ", t.lower()).split()
    df = Counter(w for t in lines for w in set(word(t)))
    known = {w for t in statements for w in word(t)} | {w for _, x in TEXTS for w in word(x)}
    idf = lambda w: math.log((1 + len(lines)) / (1 + df[w])) + 1 if w in known else math.log(1 + len(lines)) + 1

    def vector(t):
        v = {w: n * idf(w) for w, n in Counter(word(t)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    templates = [vector(t) for t in statements]
    weighted = S.weighted(*S.frequencies(spark.createDataFrame([(t,) for t in lines], "text string")))
    for t, found in zip(lines, S.licences(pa.array(lines), weighted)):
        v = vector(t)
        cosines = [sum(x * m.get(w, 0) for w, x in v.items()) for m in templates]
        best = max(range(len(cosines)), key=lambda k: (round(cosines[k], 9), -k))
        whole = [u for u in found.units if u[3] == len(word(t)) and u[0] < len(templates)]
        extra = sum(w in S.DENIALS for w in word(t)) > sum(w in S.DENIALS for w in word(statements[best]))
        if cosines[best] >= S.LEAST + 1e-9 and not extra:
            assert whole and whole[0][2] == pytest.approx(cosines[best], abs=1e-9) and cosines[whole[0][0]] == pytest.approx(cosines[best], abs=1e-9), t
        elif cosines[best] < S.LEAST - 1e-9:
            assert not whole or len(word(t)) in {len(word(x)) for x in statements}, t


def test_ties_and_several_licence_files(spark):
    rows = [("a/LICENSE", "Licensed under the MIT License."), ("a/COPYING", "Licensed under the ISC License."), ("a/x.py", prose(1, 30)), ("a/x.py", prose(1, 30)), ("a/d/LICENSE.txt", "The MIT License (MIT)"), ("a/d/y.py", prose(2, 30))]
    docs = spark.createDataFrame([doc(k, t) for k, (_, t) in enumerate(rows)], DOCS).withColumn("path", F.element_at(F.array(*[F.lit(p) for p, _ in rows]), F.col("doc_id").cast("int") + 1))
    got = S.scan(docs, F.col("path")).collect()
    assert len(got) == len(rows) and [r["inherited"] for r in got if r["path"] == "a/x.py"] == ["ISC", "ISC"]
    assert [(r["inherited"], r["inherited_from"]) for r in got if r["path"] == "a/d/y.py"] == [("MIT", "a/d")]
    twice = S.licences(pa.array(["Licensed under the MIT License.\n\nLicensed under the ISC License."]), S.weighted(10, np.zeros(len(S.Templates.fixed().terms))))[0]
    assert {S.Templates.fixed().names[u[0]] for u in twice.units} == {"MIT", "ISC"}
