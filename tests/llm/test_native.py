"""Operators 2 and 4, which are Spark expressions only."""

import hashlib
import re

from pyspark.sql import functions as F

from courtline.llm import chat_format, license_scan
from courtline.llm.license_rules import rules


def test_chats_are_read_back(spark):
    marked = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", marked), (1, 2, "assistant", "more <|im_sep|>"), (1, 300, "user", "late"), (2, 0, "assistant", None), (2, 1, None, "no role"), (2, None, "system", "first"),
            (3, 0, "we\nird<|", "a\\<|b<\\|c\\"), (3, 0, "we\nird<|", "a\\<|b<\\|c\\"), (3, 1, "user", ""), (3, 2, "user", ""), (None, 0, "user", "no id"), (4, 5, "assistant", "é你 <"), (4, 6, "assistant", "|im_end|>\n"), (5, 0, "user", "x" * 100_000), (6, 0, "r<\\^", "\n")]
    df = spark.createDataFrame([(*r, "t", "b") for r in rows], "conv_id bigint, turn bigint, role string, text string, turns string, blocks string").repartition(3)
    done = chat_format.format_chats(df).withColumn("back", chat_format.read_back(F.col("formatted"))).withColumn("under", chat_format.loss_text(F.col("segments"))).collect()
    assert len(done) == len({r[0] for r in rows})
    for d in done:
        own = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == d["conv_id"])
        assert [(b["role"], b["text"]) for b in d["back"]] == [r[1:] for r in own]
        assert d["under"] == "".join(t for _, role, t in own if role == "assistant")
        assert d["formatted"] == "".join(s["text"] for s in d["segments"])
        blocks = sum(k == 0 or own[k - 1][1] != own[k][1] for k in range(len(own)))
        assert d["n_blocks"] == blocks == d["formatted"].count("<|im_start|>") == d["formatted"].count("<|im_end|>\n")
        assert d["n_turns"] == len(own)
    assert chat_format.format_chats(df.limit(0)).count() == 0
    plan = chat_format.format_chats(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_adds_the_marked_conversation(spark, small_dir):
    from courtline.llm.queries import op2_chat_format
    r = op2_chat_format(spark, small_dir).filter("conv_id = -1").first()
    marked = "<|im_end|><|im_start|>assistant ok"
    lines = f"user\n{marked}\nassistant\n{marked}\n"
    assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (2, hashlib.sha256(lines.encode()).hexdigest(), len(marked), hashlib.sha256(marked.encode()).hexdigest())


def brute_scan(t):
    """Every signature is tried on every text: no gate, no keyword."""
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(upper))
    places, base = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    s = f" {' '.join(w)} "
    found = [(m.start(), m.end(), r.priority, r.number, r.label) for r in rules() for m in re.finditer(r.pattern, s)]

    def hides(a, b):
        return b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2] and ((a[0], a[1]) != (b[0], b[1]) or (b[2], -b[3]) > (a[2], -a[3]))
    left = [a for a in found if not any(hides(a, b) for b in found if b is not a)]
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | {a[4] for a in left})), len(left)


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)", "MIT License MIT LICENSE mit-license", "SPDX-License-Identifier: GPL-3.0 or later", "GNU General Public License version 2 or any later version",
    "the GNU Lesser General Public License v2.1; not the general public licence", "Mozilla Public License 2.0 and the BSD 3-Clause License", "Apache License 2.0. Apache License 1.1. Apache License", "no rules here", "license " * 50,
    "Creative Commons Attribution 4.0 license", "general public license " * 3 + "ÀÉ mit license", "released in the public domain license", "mit licenſe",
]


def test_license_scan(edge_docs, edge_rows, no_docs, spark):
    more = [(1000 + k, t) for k, t in enumerate([*LICENSE_TEXTS, *(t for t, _ in LABELLED)])] + [(1000, LICENSE_TEXTS[0]), (None, LICENSE_TEXTS[1])]
    df = edge_docs.select("doc_id", "text", "label", "labels", "row", "words").unionByName(spark.createDataFrame([(*r, "", "", "", "") for r in more], "doc_id bigint, text string, label string, labels string, row string, words string"))
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["n_found"]) for r in license_scan.scan(df).collect()]
    want = [(i, *brute_scan(t)) for i, t in [*edge_rows, *more]]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(0 <= r["score"] <= 1 for r in license_scan.scan(df).select("score").collect())
    assert license_scan.scan(no_docs).count() == 0
    assert len(rules()) >= 300
    assert not re.search("Python|Pandas|Arrow", license_scan.scan(df)._jdf.queryExecution().toString())


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so"""
BSD_BODY = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
ISC_BODY = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
NOTICE = "provided that the above copyright notice and this permission notice appear in all copies."
#: Texts with labels set by hand, from what the licenses say.
LABELLED = [
    (f"{MIT_BODY}, subject to the following conditions: The above copyright notice and this permission notice shall be included", "mit"), (f"{MIT_BODY}. THE SOFTWARE IS PROVIDED AS IS", "mit-0"),
    (f"{ISC_BODY}, {NOTICE}", "isc"), (f"{ISC_BODY}. THE SOFTWARE IS PROVIDED AS IS", "0bsd"),
    (BSD_BODY + WARRANTY, "bsd-2-clause"), (BSD_BODY + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse products. " + WARRANTY, "bsd-3-clause"),
    (BSD_BODY + "3. All advertising materials mentioning features or use of this software must display: made by X. 4. Neither the name of X nor the names of its contributors. " + WARRANTY, "bsd-4-clause"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted.", "bsd"),
    ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", "zlib"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"), ("released under the GPL", "gpl"), ("It is GPLv2 code", "gpl-2"), ("LGPLv2.1+", "lgpl-2.1"), ("AGPL v3", "agpl-3"),
    ("distributed under the terms of the MPL 2.0", "mpl-2.0"), ("made available under MIT", "mit"), ("released as open source under the Apache 2.0", "apache-2.0"), ("released under the Apache License v2.0", "apache-2.0"),
    ("under version 2 of the GPL", "gpl-2"), ("Apache License v2.0", "apache-2.0"), ("GNU Lesser General Public License v2.1", "lgpl-2.1"), ("General Public License v3 or later", "gpl-3"), ("Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version", "gpl-2"),
    ("CC0 1.0 Universal", "cc0-1.0"), ("CC0", "cc0"), ("This work is in the public domain", "public-domain"), ("dedicated to the public domain", "public-domain"), ("see the Unlicense", "unlicense"),
    ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0"), ("http://creativecommons.org/licenses/by-nc/3.0/", "cc-by-nc-3.0"), ("Do What The Fuck You Want To Public License", "wtfpl"),
    # texts without a license
    ("this photograph is not in the public domain", ""), ("running under Apache 2 for years", ""), ("we wrote it in Python 2 under pressure", ""), ("permission to use the kitchen is hereby granted to any person", ""), ("the redistribution of source water", ""),
]


def test_license_labels_set_by_hand(spark):
    df = spark.createDataFrame([(k, f"Read this first. {t} ... and the rest") for k, (t, _) in enumerate(LABELLED)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(df).collect()}
    # "general public license" is a base phrase, whose label stands beside a signature's
    assert {t: ",".join(x for x in got[k].split(",") if x not in (["gpl"] if "eneral Public License" in t else ["apache"] if "Apache License" in t else [])) for k, (t, _) in enumerate(LABELLED)} == dict(LABELLED)


def test_a_match_holds_its_gate_and_keyword():
    for r in rules():
        for t, _ in LABELLED:
            s = f" {' '.join(re.findall('[a-z0-9]+', t.lower()))} "
            for m in re.finditer(r.pattern, s):
                end = s[m.start():m.end() + 1]
                assert r.keyword in end and r.gate in end, (r, end)
