"""License scans by sentence rules, as DataFrame expressions.

A text is cut into sentences after . ! ? : ; before white space, and at lines without a letter or digit; a line break
alone does not end a sentence, so wrapped notices and those in comments are read as they are meant. A sentence in small
letters, with everything but letters and digits as single spaces and a holder's name in a known place left out, is looked up
among the known licence sentences; if it is not there, its lines are looked up one by one, as a short notice may stand between
other lines. What is found is the document's sequence of sentence identifiers. A rule is an ordered list of identifiers: it
holds if they occur in that order; other sentences may stand between them. "All rights reserved" counts only where no
licence is found. Only texts that hold one of KEYS are cut; no other one can hold a known sentence.

Null and empty texts have no sentence and no licence. Repeated rows give repeated rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the apache license version 2 0",
    3: "this work is licensed under the gnu general public license version 3",
    4: "licensed under cc by nc 4 0",
    5: "licensed under the mit license",
    6: "permission is hereby granted free of charge to any person obtaining a copy of this software",
    7: "the software is provided as is without warranty of any kind",
    8: "you may not use this file except in compliance with the license",
    9: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    10: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    11: "this software is provided by the copyright holders and contributors as is",
    12: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    13: "this program is distributed in the hope that it will be useful but without any warranty",
    14: "this work is licensed under a creative commons attribution 4 0 international license",
    15: "licensed under cc by 4 0",
    16: "licensed under cc by sa 4 0",
    17: "all rights reserved",
    18: "this work is dedicated to the public domain",
    19: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    20: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    21: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    22: "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    23: "licensed under the apache license version 2 0 the license",
    24: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    25: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    26: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    27: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    28: "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    29: "this program is free software",
    30: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    31: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    32: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    33: "without even the implied warranty of merchantability or fitness for a particular purpose",
    34: "this library is free software",
    35: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    36: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    37: "this library is distributed in the hope that it will be useful but without any warranty",
    38: "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    39: "this source code form is subject to the terms of the mozilla public license v",
    40: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    41: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    42: "this is free and unencumbered software released into the public domain",
    43: "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    44: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    45: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    46: "this work is licensed under the creative commons attribution 4 0 international license",
    47: "this work is licensed under the creative commons attribution sharealike 4 0 international license",
    48: "this work is licensed under the creative commons attribution noncommercial 4 0 international license",
    49: "spdx license identifier",
    50: "mit",
    51: "apache 2 0",
    52: "gpl 3 0 or later",
    53: "gpl 2 0 or later",
    54: "bsd 3 clause",
    55: "bsd 2 clause",
    56: "mpl 2 0",
    57: "released into the public domain",
    58: "this software is released under the mit license",
    59: "this project is licensed under the mit license",
    60: "this project is licensed under the apache license version 2 0",
    61: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    62: "either version 2 of the license or at your option any later version",
    63: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    64: "either version 2 1 of the license or at your option any later version",
    65: "either version 3 of the license or at your option any later version",
}
# Rules, each a licence and the identifiers that must follow one another.
RULES = [
    ("AGPL-3.0", (38, 33)),
    ("AGPL-3.0", (38, 32)),
    ("Apache-2.0", (2,)),
    ("Apache-2.0", (8, 9)),
    ("Apache-2.0", (23, 8)),
    ("Apache-2.0", (8, 24)),
    ("Apache-2.0", (49, 51)),
    ("Apache-2.0", (60,)),
    ("BSD", (10, 11)),
    ("BSD-2-Clause", (10, 25, 26, 28)),
    ("BSD-2-Clause", (49, 55)),
    ("BSD-3-Clause", (10, 25, 26, 27)),
    ("BSD-3-Clause", (49, 54)),
    ("CC-BY-4.0", (14,)),
    ("CC-BY-4.0", (15,)),
    ("CC-BY-4.0", (46,)),
    ("CC-BY-NC-4.0", (4,)),
    ("CC-BY-NC-4.0", (45,)),
    ("CC-BY-NC-4.0", (48,)),
    ("CC-BY-SA-4.0", (16,)),
    ("CC-BY-SA-4.0", (44,)),
    ("CC-BY-SA-4.0", (47,)),
    ("GPL-2.0", (31, 33)),
    ("GPL-2.0", (31, 32)),
    ("GPL-2.0", (49, 53)),
    ("GPL-2.0", (61, 62)),
    ("GPL-3.0", (3,)),
    ("GPL-3.0", (12, 13)),
    ("GPL-3.0", (30, 33)),
    ("GPL-3.0", (30, 32)),
    ("GPL-3.0", (49, 52)),
    ("GPL-3.0", (61, 65)),
    ("ISC", (41,)),
    ("LGPL-2.1", (35, 33)),
    ("LGPL-2.1", (63, 64)),
    ("LGPL-3.0", (36, 33)),
    ("LGPL-3.0", (63, 65)),
    ("MIT", (1,)),
    ("MIT", (5,)),
    ("MIT", (6, 7)),
    ("MIT", (19, 21)),
    ("MIT", (49, 50)),
    ("MIT", (58,)),
    ("MIT", (59,)),
    ("MPL-2.0", (39,)),
    ("MPL-2.0", (49, 56)),
    ("Public-Domain", (18,)),
    ("Public-Domain", (57,)),
    ("Unlicense", (42, 43)),
]
# Licences that another one, found as well, includes; and the notice that counts only alone.
WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}
ALONE = ("Proprietary", 17)
#: Every known sentence holds one of these, or follows one that does.
KEYS = "licen|software|redistribut|warrant|rights reserved|public domain|permission"
#: Ends of sentences: marks before white space, and lines without a letter or digit.
ENDS = r"[.!?:;]+[\x20\x09-\x0D]+|\n[^\p{L}\p{N}\n]*\n"
#: A place where a holder's name stands, and what is put there.
HOLDER = (r"^neither the name of .* nor the names of its contributors", "neither the name of the copyright holder nor the names of its contributors")


def in_order(ids: F.Column, rule: tuple[int, ...]) -> F.Column:
    """Whether the rule's identifiers occur in this order, by a fold over a document's identifiers that moves on with each one met."""
    met = F.lit(True)
    for i in rule:
        met = met & F.array_contains(ids, i)
    steps = F.array(*map(F.lit, rule))
    fold = F.aggregate(ids, F.lit(0), lambda k, i: F.when(F.get(steps, k) == i, k + 1).otherwise(k)) == len(rule)
    return met if len(rule) == 1 else F.when(met, fold).otherwise(F.lit(False))


def rule_pattern(ids: tuple[int, ...]) -> str:
    """The SQL's pattern over ",3,12,13," that holds if the identifiers occur in this order."""
    return "," + ",(?:[0-9]+,)*".join(str(i) for i in ids) + ","


def _rules() -> dict[str, list[str]]:
    held: dict[str, list[str]] = {}
    for name, rule in RULES:
        held.setdefault(name, []).append(rule_pattern(rule))
    return held


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sentence_ids (in order, joined by commas), n_sentences known, and licenses (names in order, joined)."""
    known = F.create_map(*[x for i, s in SENTENCES.items() for x in (F.lit(s), F.lit(i))])
    plain = lambda s: F.regexp_replace(F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")), *HOLDER)
    of = lambda s: F.try_element_at(known, plain(s))
    lines = lambda s: F.transform(F.split(s, "\n"), of)
    each = lambda s: F.transform(F.array(of(s)), lambda i: F.when(i.isNotNull() | ~s.contains("\n"), F.array(i)).otherwise(lines(s)))[0]
    cut = F.split(F.regexp_replace("text", ENDS, "\u0001"), "\u0001")
    found = texts(docs, doc_id, text).select("doc_id", F.when(F.lower("text").rlike(KEYS), cut).otherwise(F.array().cast("array<string>")).alias("sentences"))
    found = found.select("doc_id", F.array_compact(F.flatten(F.transform("sentences", each))).alias("ids"))
    found = found.select("doc_id", "ids", F.array_join(F.col("ids").cast("array<string>"), ",").alias("sentence_ids"), F.size("ids").cast("long").alias("n_sentences"))
    held = {}
    for name, rule in RULES:
        held[name] = held.get(name, F.lit(False)) | in_order(F.col("ids"), rule)
    names = F.array(*[F.when(c & ~held[WITHIN[n]] if n in WITHIN else c, F.lit(n)) for n, c in held.items()])
    joined = F.array_join(F.array_compact(names), ",")
    named = found.withColumn("licenses", joined)
    return named.withColumn("licenses", F.when((F.col("licenses") == "") & F.array_contains("ids", ALONE[1]), ALONE[0]).otherwise(F.col("licenses"))).drop("ids")


def oracle() -> str:
    """The same in DuckDB's SQL."""
    known = " UNION ALL ".join(f"SELECT {i} AS id, '{s}' AS s" for i, s in SENTENCES.items())
    hold = {n: " OR ".join(f"regexp_matches(',' || sentence_ids || ',', '{p}')" for p in ps) for n, ps in _rules().items()}
    names = ", ".join(f"CASE WHEN ({c}){f' AND NOT ({hold[WITHIN[n]]})' if n in WITHIN else ''} THEN '{n}' END" for n, c in hold.items())
    plain = lambda s: f"regexp_replace(trim(regexp_replace(lower({s}), '[^a-z0-9]+', ' ', 'g')), '{HOLDER[0]}', '{HOLDER[1]}')"
    return f"""
    WITH known AS ({known}),
    d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
    cut AS (SELECT rid, unnest(parts) AS s, generate_subscripts(parts, 1) AS k FROM (
        SELECT rid, string_split(regexp_replace(text, '{ENDS}', chr(1), 'g'), chr(1)) AS parts FROM d WHERE regexp_matches(lower(text), '{KEYS}'))),
    whole AS (SELECT rid, k, cut.s, id FROM cut LEFT JOIN known ON known.s = {plain("cut.s")}),
    lines AS (SELECT rid, k, unnest(parts) AS s, generate_subscripts(parts, 1) AS j FROM (SELECT rid, k, string_split(s, chr(10)) AS parts FROM whole WHERE id IS NULL AND contains(s, chr(10)))),
    found AS (SELECT rid, k, 0 AS j, id FROM whole WHERE id IS NOT NULL UNION ALL SELECT rid, k, j, id FROM lines JOIN known ON known.s = {plain("lines.s")}),
    per AS (SELECT rid, string_agg(id, ',' ORDER BY k, j) AS ids, count(*) AS n FROM found GROUP BY rid),
    listed AS (SELECT doc_id, coalesce(ids, '') AS sentence_ids, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences FROM d LEFT JOIN per USING (rid)),
    named AS (SELECT *, array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS found FROM listed)
    SELECT doc_id, sentence_ids, n_sentences, CASE WHEN found = '' AND contains(',' || sentence_ids || ',', ',{ALONE[1]},') THEN '{ALONE[0]}' ELSE found END AS licenses FROM named
    """
