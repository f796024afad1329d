from collections import Counter
from math import log, sqrt

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import license_scan as S
from tallyrisk.llm.queries import ORACLE, QUERIES

MIT, APACHE = S.TEMPLATES["MIT"], S.TEMPLATES["Apache-2.0"]
FILLER = "\n".join(f"some plain words of line {i} here" for i in range(40))
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY.
"""
MIT_FILE = "Some Project\n\nCopyright (c) 2021 Some Body. All rights reserved.\n\n" + "\n\n".join(S.TEXTS[1][1].split("\nTHE ABOVE", 1))


def _scan(spark, rows):
    df = spark.createDataFrame(rows, "path string, text string, license string")
    return {r.path: r for r in S.scan(df).collect()}


def test_nearest_ancestor_and_own_header(spark):
    got = _scan(spark, [("a/LICENSE", MIT + "\n" + FILLER, ""), ("a/b/COPYING", APACHE, ""), ("a/x.py", FILLER, ""), ("a/b/y.py", FILLER, ""),
                        ("a/b/c/z.py", FILLER, ""), ("a/d/e.py", FILLER, ""), ("q/x.py", FILLER, ""), ("ab/x.py", FILLER, ""),
                        ("a/b/own.py", "# released under the mit LICENSE!\n" + FILLER, "")])
    assert {p: (r.license, r.basis) for p, r in got.items()} == {
        "a/LICENSE": ("MIT", "own"), "a/b/COPYING": ("Apache-2.0", "own"), "a/x.py": ("MIT", "inherited"), "a/b/y.py": ("Apache-2.0", "inherited"),
        "a/b/c/z.py": ("Apache-2.0", "inherited"), "a/d/e.py": ("MIT", "inherited"), "q/x.py": (None, "none"), "ab/x.py": (None, "none"),
        "a/b/own.py": ("MIT", "own")}
    assert got["a/LICENSE"].license_file and not got["a/b/own.py"].license_file


def test_wrapped_headers_and_whole_licence_files(spark):
    wrapped = "\n".join(f" * {x}" for x in S.TEXTS[3][1].replace("granted, provided", "granted,\nprovided").splitlines())
    apache = "// Copyright 2020 Some Body\n//\n" + "\n".join("// " + x for x in S.TEXTS[4][1].splitlines()) + "\n\n"
    got = _scan(spark, [("g/x.py", GPL_HEADER + "\n" + FILLER, ""), ("m/LICENSE", MIT_FILE, ""), ("m/x.py", FILLER, ""),
                        ("i/isc.c", f"/*\n{wrapped}\n */\n\n{FILLER}", ""), ("p/x.go", apache + FILLER, ""),
                        ("s/one.txt", FILLER.replace("\n", " ") + ". " + MIT + " " + FILLER.replace("\n", " "), ""),
                        ("r/x.txt", "Copyright 2020 by us. All rights reserved.\n\n" + FILLER, ""), ("l/x.txt", "a licence is good to have, in any event\n" + FILLER, "")])
    assert {p: (r.license, r.basis) for p, r in got.items()} == {
        "g/x.py": ("GPL-3.0", "own"), "m/LICENSE": ("MIT", "own"), "m/x.py": ("MIT", "inherited"), "i/isc.c": ("ISC", "own"), "p/x.go": ("Apache-2.0", "own"),
        "s/one.txt": ("MIT", "own"), "r/x.txt": ("Proprietary", "own"), "l/x.txt": (None, "none")}
    assert got["m/LICENSE"].score > 0.9 and got["m/LICENSE"].license_file


def test_every_words_frequency_counts(spark):
    """Common words around a statement weigh little, rare ones much; the score is the cosine over the whole corpus's counts."""
    around = "it may be used by you and by others here"
    texts = [f"{MIT[:-1]} {around}"] + [around + f" {i}" for i in range(60)] + ["Released under " + " ".join(f"zq{i}" for i in range(12)) + " the MIT License"]
    got = _scan(spark, [(f"d{i}/x", t, "") for i, t in enumerate(texts)])
    df = Counter(w for t in texts for w in set(S.template_words(t)))
    idf = {w: log((1 + len(texts)) / (1 + df[w])) + 1 for w in {*df, *S.template_words(" ".join(t for _, t in S.ALL))}}

    def cosine(a, b):
        x, y = ({w: c * idf[w] for w, c in Counter(S.template_words(t)).items()} for t in (a, b))
        return sum(v * y.get(w, 0) for w, v in x.items()) / sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    assert got["d0/x"].own_license == "MIT" and got["d0/x"].score == pytest.approx(cosine(texts[0], MIT), abs=1e-6)
    assert got["d61/x"].own_license is None and cosine(texts[61], MIT) < S.THRESHOLD
    assert all(got[f"d{i}/x"].license is None for i in range(1, 61))


def test_defined_cases(spark):
    rows = [(None, MIT, ""), ("p/1", None, None), ("p/2", "", ""), ("p/3", "mit " * 200_000, ""), ("p/4", f"{MIT}\n{APACHE}", ""),
            ("p/4", f"{MIT}\n{APACHE}", ""), ("top", "nothing", ""), ("p/5", "\n" * 300_000 + " \n" * 100_000, ""), ("p/6", ". " * 300_000, "")]
    df = spark.createDataFrame(rows, "path string, text string, license string").withColumns({c: F.lit("x") for c in ("unit", "u", "w", "df", "score", "up")})
    got = S.scan(df).collect()
    assert len(got) == 9 and {r.up for r in got} == {"x"}
    assert sorted((r.path, r.own_license) for r in got if r.path and r.path.startswith("p/4")) == [("p/4", "Apache-2.0")] * 2
    assert [r.license for r in got if r.path == "top"] == ["MIT"]       # the null path lies in the empty directory, as does ``top``
    assert S.scan(df.filter(F.lit(False))).count() == 0


def test_the_bound_loses_no_unit(spark):
    """Units passed over stay below the threshold even if they hold nothing but template words."""
    idf = {w: 1.0 + i / 10 for i, w in enumerate(sorted({w for _, t in S.ALL for w in S.template_words(t)}))}
    vectors = S.vectors(idf, S.ALL)
    cues = S.cues(idf, S.ALL, S.THRESHOLD)
    texts = [" ".join(w for w in S.template_words(t) if w not in cues) for _, t in S.ALL]
    texts += [" ".join(S.template_words(t)[i:i + k]) for _, t in S.ALL for k in (1, 2, 4, 8, 16, 32) for i in range(0, len(S.template_words(t)), 3)]

    def best(text):
        x = {w: c * idf[w] for w, c in Counter(text.split()).items()}
        return max((sum(v * y.get(w, 0) for w, v in x.items()) / sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
                    for y in vectors), default=0) if x else 0

    df = spark.createDataFrame([(t,) for t in texts], "unit string")
    kept = {r.unit for r in df.filter(S.may_reach(S.words(F.col("unit")), idf, S.ALL, S.THRESHOLD)).collect()}
    assert 0 < len(cues) < len(idf) and kept >= {t for t in texts if best(t) >= S.THRESHOLD} and len(kept) < len(set(texts))


def test_query_matches_sql(spark, brute):
    from tests.oracle_check import compare
    d = "/root/testdata/sf0.001"
    assert compare(QUERIES["op8_license_scan"](spark, d).toPandas(), brute(d).execute(ORACLE["op8_license_scan"]).df()) == (True, "ok")
