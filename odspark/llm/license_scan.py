"""License scans (op 5): a positional index of rare licence words, matched by relative position.

Every template (a whole short licence, the opening of a long one, or a notice) is indexed by word: postings (word, template, place). The weight of a
word is its IDF over all files that are scanned, counted in a first pass, and a template keeps the postings of its `RARE_WORDS` words of highest IDF.
A second pass looks up the licence words of each file in the index. A template of which a file holds too little weight, wherever its
words stand, can have no alignment there and is left out; the places of the others are joined with the postings, each giving an alignment
(template, place in the file - place in the template). Words that vote for starts in one window of 2 * `DRIFT` places stand at the template's relative
positions, a few words put in or left out in between; two rows of windows, half a window apart, let no two starts within `DRIFT` fall apart. An
alignment with `MIN_PERCENT` of its template's weight is kept if one of the template's key phrases begins within it, `SLACK` words to either side.
Beside that, the contract's base phrases are found at every place. Built from DataFrame and SQL functions only; no text is shuffled, and only
the document counts of the templates' own words pass through the driver.

`scan` takes other templates too; `read_templates` makes them from a folder of whole licence texts.

Words: ASCII letters lower-cased, then `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; places count words from 0.

Defined cases: a null or empty text has no words, no labels and score 0; documents without id or with equal ids stay rows of their own (id and text
tell them apart); extra columns are ignored; a word in no file has the highest weight; templates without words are left out.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import LOWER, UPPER, table, text_or_empty

# Base phrases of the contract with their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Texts that public licences share.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
          "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
          "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
             "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
             "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
             "and/or other materials provided with the distribution. ")
_BSD_TAIL = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
             "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
             "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
             "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
             "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_COPY = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

# Label, text of a public licence (whole, or the opening of a long one) or of a notice, and key phrases of which one must stand in or near it.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in "
            "the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
            "notice shall be included in all copies or substantial portions of the Software. " + _AS_IS, ["permission is hereby granted free of charge"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in "
            "the Software without restriction", ["permission is hereby granted free of charge"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Licensed under the MIT License", ["mit license"]),
    ("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
                   "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall "
                   "mean the copyright owner or entity authorized by the copyright owner that is granting the License.", ["apache license version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License.", ["apache license version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. " + _GNU_COPY + " Preamble The licenses for most software "
                "are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and "
                "change free software", ["gnu general public license version 2"]),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY + " Preamble The GNU General Public License is a "
                "free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to "
                "share and change the works.", ["gnu general public license version 3"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
            "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", ["gnu general public license"]),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY + " Preamble The GNU Affero General "
                 "Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of "
                 "network server software.", ["gnu affero general public license"]),
    ("lgpl-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY + " This version of the GNU Lesser "
                 "General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed "
                 "below.", ["gnu lesser general public license"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation; either version 2.1 of the License, or (at your option) any later version.", ["gnu lesser general public license"]),
    ("bsd-2-clause", _BSD_HEAD + _BSD_TAIL, ["redistribution and use in source and binary forms"]),
    ("bsd-3-clause", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                     "without specific prior written permission. " + _BSD_TAIL, ["may be used to endorse or promote products derived from"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
            "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE.", ["permission to use copy modify and or distribute this software", "permission to use copy modify and distribute this software"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this "
             "software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
             "the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
     ["the origin of this software must not be misrepresented", "permission is granted to anyone to use this software for any purpose"]),
    ("bsl-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
     ["boost software license", "any person or organization obtaining a copy of the software"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
                "http://mozilla.org/MPL/2.0/.", ["mozilla public license v 2 0", "mozilla public license version 2 0"]),
    ("epl-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION "
                "OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.", ["eclipse public license"]),
    ("cc0-1.0", "Creative Commons CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights "
                "(defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\").",
     ["cc0 1 0 universal", "automatically confer exclusive copyright and related rights"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0", "creative commons attribution 3 0"]),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["creative commons attribution sharealike"]),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ["creative commons attribution noncommercial"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
                  "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
     ["unencumbered software released into the public domain"]),
]
RARE_WORDS = 16      # words of highest IDF that index a template
MIN_PERCENT = 50     # least part of those words' weight that one alignment must hold
DRIFT = 8            # places by which the votes of one alignment may differ
SLACK = 16           # words before and after an alignment in which a key phrase may begin
IDF_UNIT = 1000      # weights are whole numbers of 1 / IDF_UNIT

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    """The words of a template."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def read_templates(spark: SparkSession, folder: str, phrases: dict[str, list[str]]) -> list[tuple[str, str, list[str]]]:
    """Templates from a folder of whole licence texts: a file's name (without .txt) is its label; files without key phrases in `phrases` are left out.

    The texts are the index, not data that is scanned: they pass through the driver, so give a folder of licences.
    """
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.txt)?$", 1).alias("label"), "value")
    return sorted((r.label, r.value, phrases[r.label]) for r in rows.where(F.col("label").isin(*phrases)).collect())


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and w (words)."""
    # in lower case no character but an ASCII letter becomes a letter of a template, and no word falls apart
    each = F.array_remove(F.split(F.lower(text_or_empty(text_col)), GAP), "")
    # generated, not projected: a filter on what follows is then not pushed below it, which would take the words apart again for every place
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.explode(F.array(each)).alias("w"))


def starts_of(phrase: str) -> str:
    """SQL: places of a phrase in the words `w` of a text; only texts that hold its longest word are looked through."""
    parts = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(parts))
    held = f"array_contains(w, '{max(parts, key=len)}') AND size(w) >= {len(parts)}"
    return f"CASE WHEN {held} THEN filter(sequence(0, size(w) - {len(parts)}), i -> {same}) ELSE CAST(array() AS array<int>) END"


def base_places(rows: DataFrame) -> DataFrame:
    """One row per row of `words`: doc_id, text_hash, n_words, base (sorted array of (start, label))."""
    longest = sorted({max(p.split(), key=len) for p, _ in BASE})
    near = F.arrays_overlap("w", F.array(*[F.lit(x) for x in longest]))
    each = ", ".join(f"transform({starts_of(p)}, i -> named_struct('start', i, 'label', '{label}'))" for p, label in BASE)
    found = F.when(near, F.expr(f"sort_array(concat({each}))")).otherwise(F.expr("CAST(array() AS array<struct<start:int,label:string>>)"))
    return rows.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), F.explode(F.array(found)).alias("base"))


def idf(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Weight of each word of the templates: IDF_UNIT * ln(1 + files / (1 + files with the word)), counted over all rows of `words`."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    # a row for the number of files itself, under the empty word that no text holds
    each = rows.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect("w", known))).alias("word"))
    held = {r.word: r.n for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: round(IDF_UNIT * math.log(1 + held.get("", 0) / (1 + held.get(w, 0)))) for w in vocabulary}


def rare_postings(templates: list, weights: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """(word, template, first place, weight) of each template's words of highest weight; ties by word."""
    out = []
    for k, (_, text, _) in enumerate(templates):
        w = words_of(text)
        first = {x: w.index(x) for x in w}
        out += [(x, k, first[x], weights[x]) for x in sorted(first, key=lambda x: (-weights[x], x))[:RARE_WORDS]]
    return out


def _sql_list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def candidates(rows: DataFrame, templates: list, postings: list) -> DataFrame:
    """Rows of `words` with words enough of a template, in any order: `near` (those templates) and `keys` (places of their key phrases)."""
    known = sorted({w for w, *_ in postings})
    hits = rows.select("*", F.explode(F.array(F.expr(f"array_intersect(w, {_sql_list(known)})"))).alias("hits"))
    tests, least = [], RARE_WORDS
    for k in range(len(templates)):
        own = sorted(((i, w) for w, t, _, i in postings if t == k), reverse=True)
        if not own:
            continue
        total, n, got = sum(i for i, _ in own), 0, 0
        while n < len(own) and 100 * got < MIN_PERCENT * total:
            got, n = got + own[n][0], n + 1
        least = min(least, n)
        value = " ".join(f"WHEN '{w}' THEN {i}" for i, w in own)
        weight = f"aggregate(array_intersect(hits, {_sql_list(w for _, w in own)}), 0, (s, x) -> s + CASE x {value} END)"
        tests.append(f"CASE WHEN 100 * {weight} >= {MIN_PERCENT * total} THEN {k} END")
    near = hits.where(F.size("hits") >= least).select("doc_id", "text_hash", "w", F.explode(F.expr(f"array(array_compact(array({', '.join(tests)})))")).alias("near"))
    keys = ", ".join(f"CASE WHEN array_contains(near, {k}) THEN transform({starts_of(p)}, i -> named_struct('template', {k}, 'place', i)) ELSE CAST(array() AS array<struct<template:int,place:int>>) END"
                     for k, (_, _, phrases) in enumerate(templates) for p in phrases)
    return near.where(F.size("near") > 0).select("*", F.explode(F.expr(f"array(concat({keys}))")).alias("keys"))


def alignments(rows: DataFrame, templates: list) -> DataFrame:
    """(doc_id, text_hash, label, share, start): for each label its best alignment of enough weight with a key phrase near it."""
    templates = [(label, text, [" ".join(words_of(p)) for p in phrases]) for label, text, phrases in templates if words_of(text)]
    spark = rows.sparkSession
    weights = idf(rows, sorted({x for _, text, _ in templates for x in words_of(text)}))
    postings = [p for p in rare_postings(templates, weights) if p[3] > 0]
    if not postings:
        return rows.select("doc_id", "text_hash", F.lit("").alias("label"), F.lit(0.0).alias("share"), F.lit(0).alias("start")).limit(0)
    totals = {k: sum(i for _, t, _, i in postings if t == k) for k in range(len(templates))}
    values = ", ".join(f"('{w}', {k}, {at}, {i})" for w, k, at, i in postings)
    index = spark.sql(f"SELECT * FROM VALUES {values} AS t(word, template, at, weight)")   # RARE_WORDS rows a template
    facts = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}, '{label}', {totals[k]}, {len(words_of(text))})" for k, (label, text, _) in enumerate(templates))
                      + " AS t(template, label, total, length)")
    places = candidates(rows, templates, postings).select("doc_id", "text_hash", "near", "keys", F.posexplode("w").alias("place", "word"))
    votes = (places.join(F.broadcast(index), "word").where(F.array_contains("near", F.col("template")))
             .select("doc_id", "text_hash", "keys", "template", "at", "weight", (F.col("place") - F.col("at")).alias("start"))
             .select("*", F.explode(F.array(F.lit(0), F.lit(DRIFT))).alias("shift"))
             .withColumn("window", F.floor((F.col("start") + F.col("shift")) / F.lit(2 * DRIFT))))
    alignment = ["doc_id", "text_hash", "template", "shift", "window"]
    # a word of a template votes once in a window, however often it stands there
    once = votes.groupBy(*alignment, "at").agg(F.min("start").alias("start"), F.first("weight").alias("weight"), F.first("keys").alias("keys"))
    sums = once.groupBy(*alignment).agg(F.sum("weight").alias("weight"), F.min("start").alias("start"), F.first("keys").alias("keys")).join(F.broadcast(facts), "template")
    near = f"exists(keys, k -> k.template = template AND k.place BETWEEN start - {SLACK} AND start + length + {SLACK})"
    best = sums.where(F.col("weight") * 100 >= F.col("total") * MIN_PERCENT).where(near).groupBy("doc_id", "text_hash", "label").agg(
        F.max(F.struct(F.round(F.col("weight") / F.col("total"), 6).alias("share"), (-F.col("start")).alias("start"))).alias("m"))
    return best.select("doc_id", "text_hash", "label", F.col("m.share").alias("share"), (-F.col("m.start")).alias("start"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, base (array of (start, label)), found (array of (label, share, start) of aligned templates),
    base_labels and labels (sorted arrays) and score: 1 with a base phrase, else the best share of an alignment, else 0."""
    each = words(docs, id_col, text_col)
    aligned = alignments(each, TEMPLATES if templates is None else templates).groupBy(F.col("doc_id").alias("a_id"), F.col("text_hash").alias("a_hash")).agg(
        F.array_sort(F.collect_list(F.struct("label", "share", "start"))).alias("found"))
    rows = base_places(each)
    joined = rows.join(aligned, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")), "left")
    base_labels = F.array_sort(F.array_distinct(F.col("base.label")))
    found = F.coalesce("found", F.expr("CAST(array() AS array<struct<label:string,share:double,start:int>>)"))
    return joined.select(
        "doc_id", "n_words", "base", found.alias("found"), base_labels.alias("base_labels"),
        F.array_sort(F.array_union(base_labels, found["label"])).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(found["share"]), F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: base phrases, labels and score of every document."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(F.col("base.start")).cast("long").alias("first_word"),
        F.array_max(F.col("base.start")).cast("long").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def _oracle() -> str:
    """DuckDB: the base phrases at every place, and the same weights, votes and key phrases over all words of all texts."""
    base = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS s, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 1} + 1)) AS i FROM d WHERE len(w) >= {n}) WHERE "
        + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split())) for p, label in BASE if (n := len(p.split())))
    own = ", ".join(f"({k}, {w.index(x)}, '{x}')" for k, (_, text, _) in enumerate(TEMPLATES) for w in [words_of(text)] for x in sorted(set(w)))
    names = ", ".join(f"({k}, '{label}', {len(words_of(text))})" for k, (label, text, _) in enumerate(TEMPLATES))
    phrases: dict[str, list[int]] = {}
    for k, (_, _, ps) in enumerate(TEMPLATES):
        for p in ps:
            phrases.setdefault(p, []).append(k)
    keys = " UNION ALL ".join(
        f"SELECT doc_id, unnest({ts}) AS t, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 1} + 1)) AS i FROM d WHERE len(w) >= {n} AND list_contains(w, '{max(p.split(), key=len)}')) WHERE "
        + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split())) for p, ts in phrases.items() if (n := len(p.split())))
    return rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS ({base}), own(t, pos, word) AS (VALUES {own}), names(t, label, length) AS (VALUES {names}), key AS MATERIALIZED ({keys}),
x AS MATERIALIZED (SELECT * FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM d) WHERE word IN (SELECT word FROM own)),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM x GROUP BY 1),
wt AS (SELECT own.*, CAST(round({IDF_UNIT} * ln(1 + (SELECT count(*) FROM d) / (1 + coalesce(n, 0)))) AS BIGINT) AS weight FROM own LEFT JOIN df USING (word)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY weight DESC, word) AS r FROM wt) WHERE r <= {RARE_WORDS}),
tot AS (SELECT t, sum(weight) AS total FROM p GROUP BY 1),
v AS (SELECT DISTINCT doc_id, t, pos, weight, place - pos AS start, shift, floor((place - pos + shift) / {2 * DRIFT}) AS win
      FROM x JOIN p USING (word), (VALUES (0), ({DRIFT})) AS s(shift) WHERE weight > 0),
o AS (SELECT doc_id, t, shift, win, pos, weight, min(start) AS start FROM v GROUP BY ALL),
a AS (SELECT doc_id, t, shift, win, sum(weight) AS weight, min(start) AS start FROM o GROUP BY 1, 2, 3, 4),
f AS (SELECT a.doc_id, label, max(round(weight / total, 6)) AS share FROM a JOIN tot USING (t) JOIN names USING (t)
      WHERE weight * 100 >= total * {MIN_PERCENT} AND EXISTS (SELECT 1 FROM key WHERE key.doc_id = a.doc_id AND key.t = a.t AND place BETWEEN start - {SLACK} AND start + length + {SLACK}) GROUP BY 1, 2),
bb AS (SELECT doc_id, count(*) AS n, min(s) AS lo, max(s) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS ls FROM b GROUP BY 1),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS ls FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM f) GROUP BY 1),
sc AS (SELECT doc_id, max(share) AS share FROM f GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(bb.ls, '') AS base_labels, coalesce(l.ls, '') AS labels, CAST(CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN bb USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN sc USING (doc_id)"""


ORACLE = _oracle()
