"""Chat formatting, licence scans and quality rules on small rows."""

import re

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import chat_format as C
from textloom.llm import license_scan as L
from textloom.llm import quality as Q

CONV = "conv_id long, turn long, role string, text string, turn_note string"


def test_chat_round_trip_and_state_machine(spark):
    hard = ["\\", "\\h", "###", "####", "</turn>", "</turn", "a\n</turn>\nb", "\\\\e", "### User: x", "", None, "é\u0000"]
    rows = [(1, 2 * i + k, "user" if k == 0 else "assistant", t, "n") for i, t in enumerate(hard) for k in (0, 1)]
    rows += [(2, 0, "assistant", "x", None), (3, 0, None, None, None), (4, 0, "odd: role</turn>", "t", None), (None, 0, "user", "u", None),
             (5, 0, "user", "b", None), (5, 0, "user", "a", None), (5, 0, "user", "a", None)]
    out = C.format_chats(spark.createDataFrame(rows, CONV))
    got = {r["conv_id"]: r for r in out.withColumn("back", C.read_back(F.col("formatted"))).withColumn("loss", C.loss_text(F.col("segments"))).collect()}
    assert [(x["role"], x["text"]) for x in got[1]["back"]] == [(r, t or "") for t in hard for r in ("user", "assistant")]
    assert got[1]["valid"] and got[1]["loss"] == "".join(t or "" for t in hard)
    assert not got[2]["valid"] and not got[3]["valid"] and not got[None]["valid"]
    assert [(x["role"], x["text"]) for x in got[4]["back"]] == [("odd: role</turn>", "t")]
    assert [x["text"] for x in got[5]["back"]] == ["a", "a", "b"] and not got[5]["valid"]
    assert C.format_chats(spark.createDataFrame([], CONV)).count() == 0


def test_license_rules_need_their_order(spark):
    a, b = "You may not use this file except in compliance with the License.", "You may obtain a copy of the License at"
    rows = [(1, f"{a} {b}\nmore"), (2, f"{b}\n{a}"), (3, f"{a}\nother words\n{b}"), (4, "Released under the MIT License."), (5, None), (6, ""),
            (7, "x" * 100_000 + ". All rights reserved.")]
    got = {r["doc_id"]: r["licenses"] for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["Apache-2.0"], 2: [], 3: [], 4: ["MIT"], 5: [], 6: [], 7: ["proprietary"]}


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """ * This {} is free software{} you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation{} either version {} of the License, or
 * (at your option) any later version.
 *
 * It is distributed in the hope that it will be useful,
"""
BSD = """Copyright (c) 2020, Some One.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
THIRD = """3. Neither the name of the Some One Project nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_wrapped_license_texts_are_found(spark):
    texts = {
        MIT: ["MIT"], MIT.replace("\n", " ").replace(":  The", ":\n\nThe").replace("License  Copy", "License\n\nCopy").replace("One  Perm", "One\n\nPerm"): ["MIT"],
        GPL.format("program", ":", "", ",", 3): ["GPL-3.0", "GPL-3.0-or-later"], GPL.format("program", ";", "", ";", 2): ["GPL-2.0", "GPL-2.0-or-later"],
        GPL.format("library", ";", "Lesser ", ";", "2.1"): ["LGPL-2.1", "LGPL-2.1-or-later"],
        GPL.format("library", ":", "Lesser ", ",", 3): ["LGPL-3.0", "LGPL-3.0-or-later"],
        BSD.format(""): ["BSD", "BSD-2-Clause"], BSD.format(THIRD): ["BSD", "BSD-3-Clause"], MPL: ["MPL-2.0"], ISC: ["ISC"],
        "Permission is granted to no one,\nand a version 2.0 of nothing.\n": [],
        "/" + "*" * 5000 + " All rights reserved. ": ["proprietary"]}
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["licenses"] for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(texts.values()))


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for x in wins:
        seen[x] = seen.get(x, 0) + 1
    covered = {j for i, x in enumerate(wins) if seen[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_match_brute_force(spark, sf0001, docs):
    table = spark.read.parquet(f"{sf0001}/documents.parquet").select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    extra = spark.createDataFrame([(-1, "a b c d e f g h " * 3 + "z\n\n#\n#\t|<\n"), (-2, "\u00a0x \u2003 y")], "doc_id long, text string")
    rows = Q.with_counts(table.unionByName(extra)).collect()
    for r in rows:
        assert tuple(r[c] for c in Q.COUNTS) == brute_counts(r["text"]), r["doc_id"]


def test_quality_keeps_clean_and_rejects_outliers(spark, docs, no_docs):
    clean = [(i, " ".join(f"word{(i * 7 + k) % 50}a{k}" for k in range(60 + i % 9)) + ".", "en", "s", 1) for i in range(200)]
    junk = [(1000 + i, " ".join(f"{'#' * 9}{'%' * 9}{k}x{i}" for k in range(40)), "en", "s", 1) for i in range(10)]
    got = {r["doc_id"] for r in Q.keep_quality(spark.createDataFrame(clean + junk, docs.schema)).collect()}
    assert got == set(range(200))
    assert Q.keep_quality(docs).columns == docs.columns
    assert Q.keep_quality(no_docs).count() == 0


def _vectors(spark, groups, spread=1.0):
    """A statistics table of normal vectors: ``(lang, source, rows, shift)``."""
    r = np.random.default_rng(3)
    rows = []
    for lang, source, n, shift in groups:
        x = r.normal(size=(n, 4)) @ np.array([[2.0, .5, 0, 0], [0, 1.5, .3, 0], [0, 0, 3.0, 1], [0, 0, 0, 2.5]]) * spread + shift
        rows += [(len(rows) + i, lang, source, False, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(f"{s} double" for s in Q.STATS))


def _judged(stats):
    groups = Q.stored(Q.grouped(stats), "t-groups")
    return Q.judge(stats, groups, Q.fit(stats, groups)).toPandas().set_index("doc_id").sort_index()


def test_consistency_factor():
    # chi-square with 4 and 6 dimensions: 0.75 quantile 5.385
    assert abs(Q._chi2_cdf(5.385, 4) - 0.75) < 1e-4
    assert abs(Q.consistency(1 - 1e-12) - 1) < 1e-6 and 1.4 < Q.consistency() < 1.5


def test_clean_vectors_are_rejected_at_the_stated_rate(spark):
    got = _judged(_vectors(spark, [("en", "s", 40_000, 0.0)]))
    assert abs(got["distance"].mean() - 4) < 0.2
    assert (~got["kept"]).mean() <= 2e-4


def test_estimate_reaches_the_least_determinant_of_brute_force(spark):
    stats = _vectors(spark, [("en", "s", 150, 0.0), ("en", "s", 30, 40.0)])
    x = stats.select(*Q.STATS).toPandas().to_numpy()
    h, best, r = int(np.ceil(0.75 * len(x))), None, np.random.default_rng(1)
    for _ in range(200):
        keep = r.choice(len(x), 6, replace=False)
        for _ in range(30):
            m, c = x[keep].mean(0), np.cov(x[keep].T, bias=True) + 1e-9 * np.eye(4)
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            keep = np.argsort(d)[:h]
        c = np.cov(x[keep].T, bias=True)
        if best is None or np.linalg.det(c) < best[0]:
            best = np.linalg.det(c), x[keep].mean(0), c * Q.consistency()
    raw = np.einsum("ij,jk,ik->i", x - best[1], np.linalg.inv(best[2]), x - best[1])
    core = x[raw <= Q.quantile(0.975)]
    inverse = np.linalg.inv(np.cov(core.T, bias=True) * Q.consistency(0.975))
    want = np.einsum("ij,jk,ik->i", x - core.mean(0), inverse, x - core.mean(0))
    got = _judged(stats)
    # whole distance bins (1/32 of a doubling) are kept, so sets may differ by some rows
    assert np.corrcoef(np.log(got["distance"]), np.log(want))[0, 1] > 0.99
    assert (got["kept"].to_numpy() == (want <= Q.CUTOFF)).mean() > 0.98 and not got["kept"][150:].any()


def test_small_pools_are_judged(spark):
    """Rows of a small source are judged by the language or the table."""
    for sizes in ([("en", "s", 48, 0.0)], [("en", "s", 40, 0.0), ("en", "big", 500, 0.0)],
                  [("en", "s", 20, 0.0), ("de", "t", 20, 0.0), ("fr", "u", 600, 0.0)], [("en", "s", 3, 0.0)]):
        got = _judged(_vectors(spark, [*sizes, (sizes[0][0], "s", 1, 1000.0)], 0.1))
        assert got["distance"].notna().all() and got["kept"][:-1].mean() > 0.95
        if len(got) > 10:
            assert not got["kept"].iloc[-1], sizes


def test_padded_license_lines_are_read(spark):
    rows = [(1, "All rights" + " " * 3000 + "reserved."), (2, "Released under" + " *" * 2000 + " the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _s", "2 as _i", "3 as _p")
    out = L.scan_licenses(df)
    assert [(r["licenses"], len(r["sentence_ids"]), r["_s"], r["_i"], r["_p"]) for r in out.collect()] == [(["proprietary"], 1, 1, 2, 3), (["MIT"], 1, 1, 2, 3)]
