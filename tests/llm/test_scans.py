"""Operators that look at each text: against plain Python on the small table and on awkward texts."""

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sheafline.llm import byte_bpe, licenses, pii, quality, secrets
from sheafline.llm import queries as Q

AWKWARD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "a  b\n\n c"), (6, "word " * 3000), (7, "日本語 😀 é \x0b x"), (7, "日本語 😀 é \x0b x"),
    (None, "token=abcdef1234 4111 1111 1111 1111"), (8, "secret=token: abcdefgh api-key=1 API_KEY = 'zzzzzz'"), (9, "AKIA" + "Z" * 16 + "AKIA" + "Q" * 20),
    (10, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 +1 (234) 555-0000 x" + "1 " * 40), (11, "0123456789abcdef01234567" * 400), (12, "a.b@" * 50 + "c.d"), (13, "x\ny\nx\ny\nx"),
    (14, "one two three four five six seven eight nine " * 3), (15, "4111-1111-1111-1111 4111111111111112"),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, small):
    odd = spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long, found string")
    return spark.read.parquet(f"{small}/documents.parquet").withColumn("found", F.lit("clash")).unionByName(odd)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def rows_of(df, *names):
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=repr)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_bpe_equals_tiktoken(docs, plain):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in plain:
        ids = enc.encode_ordinary(t)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t)))
    assert rows_of(byte_bpe.encode_digests(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_offsets_and_stream(spark, docs):
    table = byte_bpe.byte_table(byte_bpe.vocabulary_path())
    for r in byte_bpe.encode_texts(docs.where("doc_id in (5, 7)"), with_offsets=True).collect():
        text = bytes(r["decoded"]).decode()
        assert "".join(byte_bpe.decode_stream([[i] for i in r["ids"]], table)) == text
        for k, (s, e) in enumerate(zip(r["starts"], r["ends"], strict=True)):
            piece = table[r["ids"][k]]
            assert piece in text[s:e].encode() and e > s
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(docs.where("text LIKE '日本語%'")))
    assert [bytes(r["decoded"]).decode() for r in back.collect()] == ["日本語 😀 é \x0b x"] * 2


def test_bpe_forgets_pieces_without_change():
    few = byte_bpe.Encoder(byte_bpe.vocabulary_path(), kept=4)
    many = byte_bpe.Encoder(byte_bpe.vocabulary_path())
    for t in ["a b c d e f g", "g f e.\nd, c", "a b,c"]:
        assert few.encode(t) == many.encode(t)


def secrets_by_hand(t):
    found = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_base_spans(docs, plain):
    want = []
    for i, t in plain:
        f = secrets_by_hand(t)
        n = [sum(k == x for _, k, _ in f) for x in range(3)]
        want.append((i, *n, sha(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in f))))
    got = secrets.find_secrets(docs)
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)
    for r in got.collect():
        kept = [x for x in r["spans"].split(",") if x and not x.startswith("random")]
        assert sha(",".join(kept)) == r["base_sha256"]


def test_random_tokens_are_told_from_words(spark):
    import random

    rng = random.Random(3)
    token = lambda: "".join(rng.choice(secrets.ALNUM) for _ in range(30)) + "7k"
    words = ["internationalisation", "counterrevolutionaries", "electroencephalograph", "incomprehensibilities", "uncharacteristically", "antidisestablishmentarianism"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(150)) + f" {token()} end gggggggggggggggg1111111111111111") for i in range(40)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sum("random" in r["spans"] for r in got)
    assert found >= 28
    for r in got:
        text = dict(rows)[r["doc_id"]]
        for x in r["spans"].split(","):
            if x:
                _, s, e = x.split(":")
                assert "gggg" not in text[int(s) : int(e)]
    clean = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum("[SECRET]" in r["text"] for r in clean) == found


def test_random_keys_of_all_lengths_without_long_words(spark):
    import random

    rng = random.Random(5)
    words = "the report of a calm day in town was read by all who came and then they left for home in 1999 or 2004 again".split()
    kinds = [secrets.ALNUM, secrets.BASE64[:62] + "+/", secrets.BASE32]
    plain = ["the-report-of-the-town-was-read-2", "Home_And_Report_Of_1999", "CAMETHENALLLEFTFORHOME7", "/report/2004/the-calm-day-in-the-town/home"]
    rows, keys = [], {}
    for i, size in enumerate([21, 24, 28, 32, 40, 64, 65, 100, 128, 200] * 12):
        keys[i] = "".join(rng.choice(kinds[i % 3]) for _ in range(size - 2)) + ("7K" if i % 3 == 2 else "7k")
        rows.append((i, " ".join(rng.choice(words) for _ in range(60)) + f" {keys[i]} {plain[i % 4]} end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hits = {}
    for r in secrets.find_secrets(docs).collect():
        text = rows[r["doc_id"]][1]
        shown = [text[int(s) : int(e)] for _, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert all(x == keys[r["doc_id"]] for x in shown), shown
        hits[len(keys[r["doc_id"]])] = hits.get(len(keys[r["doc_id"]]), 0) + len(shown)
    assert all(n >= 9 for n in hits.values()) and sum(hits.values()) >= 112, hits
    clean = secrets.redact(docs).collect()
    assert sum("[SECRET]" in r["text"] for r in clean) == sum(hits.values())


def test_random_keys_in_the_given_table(spark):
    """Keys of four lengths planted among the documents of the given table, outside the base patterns."""
    import random

    rng = random.Random(11)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    keys = {9_000_000 + i: "".join(rng.choice(secrets.ALNUM) for _ in range([18, 32, 40, 64][i % 4] - 2)) + "7k" for i in range(200)}
    planted = spark.createDataFrame([(i, f"the note says {k} and no more") for i, k in keys.items()], "doc_id long, text string")
    got = secrets.find_secrets(docs.unionByName(planted)).where("spans LIKE '%random%'").select("doc_id", "spans").collect()
    hits = {n: sum(r["doc_id"] in keys and len(keys[r["doc_id"]]) == n for r in got) for n in (18, 32, 40, 64)}
    assert all(n >= 45 for n in hits.values()), hits
    assert sum(r["doc_id"] not in keys for r in got) <= 2


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def personal_by_hand(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def test_personal_base_spans(docs, plain):
    want = []
    for i, t in plain:
        f = personal_by_hand(t)
        n = [sum(k == x for _, k, _ in f) for x in range(4)]
        want.append((i, *n, sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in f))))
    got = pii.find_personal_data(docs)
    assert rows_of(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)


def test_revealing_terms(spark):
    filler = "lorem ipsum dolor sit amet consectetur elit sed do eiusmod".split()
    rows = [(i, f"report {filler[i % 10]} by Quillfeather at q.f@ex.org about {filler[(i * 3) % 10]} number w{i}\nplain line {i}") for i in range(8)]
    rows += [(100 + i, f"the report {filler[i % 10]} at noon line {i} about things") for i in range(200)] + [(500, "Quillfeather, again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    assert got[500] == "term:0:12" and "term:" in got[0] and got[100] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[500] == "Q., again" and "[EMAIL]" in clean[0] and "Quillfeather" not in clean[0] and clean[150] == dict(rows)[150]


def test_personal_data_with_null_and_repeated_ids(spark):
    filler = "lorem ipsum dolor sit amet consectetur elit sed do eiusmod".split()
    rows = [(i, f"report {filler[i % 10]} by Quillfeather at q.f@ex.org about {filler[(i * 3) % 10]} number w{i}\nplain line {i}") for i in range(8)]
    rows += [(1000 + i, f"the report {filler[i % 10]} at noon line {i} about things") for i in range(1500)]
    odd = {
        (None, "Quillfeather, again"): ("term:0:12", "Q., again"), (None, "so Quillfeather wrote a@b.org"): ("term:3:15,email:22:29", "so Q. wrote [EMAIL]"), (None, "nothing here"): ("", "nothing here"),
        (700, "told of Quillfeather"): ("term:8:20", "told of Q."), (700, "x@y.org is theirs"): ("email:0:7", "[EMAIL] is theirs"), (700, "no data in this one"): ("", "no data in this one"), (None, None): ("", None),
    }
    docs = spark.createDataFrame(rows + list(odd) + [(None, "Quillfeather, again")], "doc_id long, text string")
    want = sorted([(i, s) for (i, _), (s, _) in odd.items()] + [(None, "term:0:12")], key=repr)
    assert rows_of(pii.find_personal_data(docs).where("doc_id IS NULL OR doc_id = 700"), "doc_id", "spans") == want
    want = sorted([(i, c) for (i, _), (_, c) in odd.items()] + [(None, "Q., again")], key=repr)
    assert rows_of(pii.sanitise(docs).where("doc_id IS NULL OR doc_id = 700"), "doc_id", "text") == want


def terms_by_hand(rows, near=8, disclosure=0.8, together=2, z=1.96):
    """The revealing terms of (text,) rows, in plain Python."""
    import math
    from collections import Counter

    strip = lambda w: re.sub(r"^[\W_]+|[\W_]+$", "", w.lower())
    lines = {x for t in rows for x in t.split("\n") if x}
    seen = set()
    for line in lines:
        tokens, places, at = [], [], 0
        for s, k, e in personal_by_hand(line):
            tokens += WORD.findall(line[at:s])
            places.append(((k, line[s:e]), len(tokens)))
            tokens.append(line[s:e])
            at = max(at, e)
        tokens += WORD.findall(line[at:])
        for entity, i in places:
            seen.add((entity, tuple(tokens[max(0, i - near) : i][::-1] + tokens[i + 1 : i + 1 + near])))
    joint, n_entity = Counter(), Counter(e for e, _ in seen)
    for entity, words in seen:
        joint.update((entity, w) for w in {strip(w) for w in words} if re.search(r"[^\W\d_]", w) and w != entity[1].lower())
    n_term = Counter(w for line in lines for w in {strip(w) for w in WORD.findall(line)})
    out = set()
    for (entity, term), k in joint.items():
        n = max(n_term[term], k)
        p = k / n
        bound = (p + z * z / (2 * n) - math.sqrt(z * z * (p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)
        if k >= together and 1 + math.log(bound) / math.log(max(len(lines) / n_entity[entity], 1.0000001)) >= disclosure:
            out.add((f"{entity[0]}:{entity[1]}", term))
    return out


def test_terms_equal_brute_force(spark):
    import random

    rng = random.Random(9)
    people = [(f"Name{k}son", f"n{k}@mail.example.org") for k in range(12)]
    word = lambda: f"w{rng.randrange(300)}"
    texts = []
    for i in range(400):
        lines = [" ".join(word() for _ in range(12)) for _ in range(3)]
        if i % 4 == 0:
            name, mail = people[rng.randrange(12)]
            long = "x" * 200 if i % 16 == 0 else word()  # a word beyond the first reach
            lines.append(f"{word()} {long} ({name}), {word()} {mail}; {word()} {long} {word()} \u00e9t\u00e9")
        texts.append("\n".join(lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = pii._keyed(docs)
    got = {(r["entity"], r["term"]) for r in pii.revealing_terms(keyed, pii.with_spans(keyed)).collect()}
    want = terms_by_hand(texts)
    assert got == want and sum(t.startswith("name") for _, t in want) >= 8


def test_terms_of_long_texts_take_linear_time(spark):
    import time

    def run(n):
        rows = [(1, " ".join("Quillfeather," if i % 50 == 0 else f"w{i % 97}" for i in range(n)))]
        rows += [(2 + i, f"note {i} by Quillfeather at q.f@ex.org n{i}") for i in range(8)] + [(100 + i, f"plain line {i} w{i % 97}") for i in range(4000)]
        start = time.time()
        row = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 1").first()
        return row["n_found"], time.time() - start

    run(1000)
    (few, a), (many, b) = run(40_000), run(80_000)
    assert (few, many) == (800, 1600) and b < 2 * a + 5


def test_long_texts_do_not_overflow(spark):
    rows = [(1, "1" * 50_000), (2, "a." * 20_000 + "@" + "b." * 20_000 + "c"), (3, "1.2" * 20_000), (4, "x" * 200_000)]
    got = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2]["n_email"] == 1 and got[1]["n_card"] == 0


def quality_by_hand(t):
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_base(docs, plain, spark, small):
    want = []
    for i, t in plain:
        b = quality_by_hand(t)
        want.append((i, *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    got = quality.judge(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
    assert got.where("base_failed AND kept").isEmpty()


def test_binomial_limit_is_exact(spark):
    from math import comb, log

    for n, share, level in [(50, 0.1, 0.05), (400, 0.02, 0.01), (3000, 0.05, 0.001), (10, 0.004, 0.01)]:
        k, total = -1, 0.0
        while True:
            total += comb(n, k + 1) * share ** (k + 1) * (1 - share) ** (n - k - 1)
            if total > level:
                break
            k += 1
        row = spark.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(log(level)).alias("level")).select(quality.most_false("n", share, "level").alias("k")).first()
        assert row["k"] == k, (n, share, level)
    far = spark.range(1).select(F.lit(50_000_000).cast("long").alias("n"), F.lit(log(0.01)).alias("level")).select(quality.most_false("n", 0.01, "level").alias("k")).first()["k"]
    assert abs(far - (500_000 - 2.326 * (500_000 * 0.99) ** 0.5)) < 20


def test_quality_cutoffs_reject_junk_and_spare_good(spark):
    good = [(i, "plain words in a calm row of text that runs on " + " ".join(f"w{i}x{k}" for k in range(30)), "en") for i in range(4000)]
    bad = [(10_000 + i, " ".join(f"###b{i}x{k}$$$" for k in range(30)), "en") for i in range(300)]
    few = [(20_000 + i, " ".join(f"###b{i}x{k}$$$" for k in range(30)), "xx") for i in range(5)]
    docs = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 10_000)) for i, *_ in good + bad + few], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in bad)
    assert all(got[i] for i, *_ in few)  # too few labels to back any cutoff


def test_licenses(spark):
    rows = [
        (1, "Intro.\nReleased under the MIT License.\nmore"), (2, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Other! The software is provided \"AS IS\", without warranty of any kind."),
        (3, "The software is provided as is, without warranty of any kind. Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (4, None), (5, ""),
        (6, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."),
    ]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "", 4: "", 5: "", 6: "Apache-2.0,CC-BY-NC-4.0"}


NOTICES = {
    "Apache-2.0": """# Copyright 2021 The Authors. All Rights Reserved.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os""",
    "MIT": """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "GPL-3.0": """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */""",
    "BSD-3-Clause": """Copyright (c) 2019, A Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of Example Works nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "MPL-2.0": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "Proprietary": "some words\nAll rights reserved.\nmore words",
}


def test_wrapped_notices(spark):
    rows = [(i, t) for i, t in enumerate(NOTICES.values())] + [(50, "one line\nReleased under the MIT License" + " " * 400 + "\nnext line"), (51, "int x; // SPDX-License-Identifier: Apache-2.0\n")]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(NOTICES)) | {50: "MIT", 51: "Apache-2.0"}


def test_licenses_equal_sql(spark, docs):
    import duckdb
    import pandas as pd

    rows = [(i, r["text"]) for i, r in enumerate(docs.select("text").collect())] + [(5000 + i, t) for i, t in enumerate(NOTICES.values())]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = sorted(duckdb.sql(licenses.oracle()).fetchall())
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("name", ["op1_quality", "op6_licenses", "op7_mixing", "op8_byte_bpe", "op9_secrets", "op10_personal_data", "op5_toxicity"])
def test_empty_tables(spark, small, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert Q.queries()[name](spark, str(tmp_path)).count() == 0


def test_rules_over_a_very_long_list_of_sentences(spark):
    known = {i: s for i, s in licenses.SENTENCES.items()}
    many = ". ".join([known[6]] + [known[58]] * 20_000 + [known[7]]) + "."
    back = ". ".join([known[7], known[6]]) + "."
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(spark.createDataFrame([(1, many), (2, back)], "doc_id long, text string")).collect()}
    assert got[1] == "MIT" and got[2] == ""
    ids = [([a, b, c], rule) for a in (6, 7, 10) for b in (6, 25) for c in (7, 26) for rule in ((6, 7), (10, 25, 26), (7,))]
    for rule in ((6, 7), (10, 25, 26), (7,)):
        rows = [(k, x) for k, (x, r) in enumerate(ids) if r == rule]
        folded = {r["k"]: r["m"] for r in spark.createDataFrame(rows, "k int, ids array<int>").select("k", licenses.in_order(F.col("ids"), rule).alias("m")).collect()}
        assert folded == {k: bool(re.search(licenses.rule_pattern(rule), "," + ",".join(map(str, x)) + ",")) for k, x in rows}


def test_candidates_beside_many_base_spans():
    text = " ".join(f"password=abc{i:05d} k{i:03d}zQ9xV7mB2nW4tR6 AKIA{i:016d}" for i in range(1500))
    base = secrets.base_spans(text)
    want = [(m.start(), m.end()) for m in secrets.mixed(text) if not any(s < m.end() and e > m.start() for s, _, e in base)]
    assert [x[:2] for x in secrets.candidates(text, base)] == want and len(want) >= 1000


def test_the_ranks_are_those_of_the_vocabulary():
    import public_tokenizers

    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    assert ranks == dict(enumerate(byte_bpe.byte_table(byte_bpe.vocabulary_path())))
