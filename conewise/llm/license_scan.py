r"""License scans by diagonal voting.

All rolling word k-grams of every text are joined by hash to the places where
the templates hold them.  A hit at word ``pos`` of the text and ``tpos`` of a
template votes for the diagonal ``pos - tpos``.  Votes are added up for each
document, template and diagonal, neighbouring diagonals (a word more or less in
the text) are merged, and a merged span is verified: enough of the template's
different grams must stand in it, within the length that the template allows.
A merged span that is longer (a short notice again and again) is split: of the
stretches of allowed length that hold enough grams, those with the most grams,
then the shortest, then the first are taken, as long as they do not overlap.
Hashes only propose: the words of each span are read from the text, enough of the
template's words must stand there in order (longest common subsequence), and so
must the words that tell the template from its relatives (``lesser general public
license``).  Of equal rows (same id and text) the words are read once.

Phrases are templates too: a phrase stands where one diagonal has the votes of
all its grams.  Short templates use grams of two words, long ones of four, told
apart by 64-bit hashes.

The templates are a given list, so their table has a fixed size and is
broadcast.  A document's hits are reduced to diagonals before any shuffle.

Defined cases: a null text is empty and has no words; a null id is an id of its
own; equal rows each give a row, with equal results; texts of any length are read
whole; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conewise.llm import shingles
from conewise.llm.common import TEXT_ROWS, plain_text, read_table, ship, written

SHORT, LONG = 2, 4

#: Bytes between words: words are runs of ASCII letters and digits and of all characters above ASCII.
GAPS = np.array([not (chr(b).isalnum() if b < 128 else True) for b in range(256)])

#: The base phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Short notices and opening words of public licenses, the labels that they add, and words that must stand in them.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", ""),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2.0", ""),
    ("licensed under the apache license version 2 0", "apache-2.0", ""),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl",
     "gnu general public license"),
    ("licensed under the gnu general public license version 3", "gpl-3.0", "version 3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "bsd", ""),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", ""),
    ("this is free and unencumbered software released into the public domain", "unlicense", ""),
    ("licensed under cc by nc 4 0", "cc-by-nc", "by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "by sa"),
    ("licensed under a creative commons attribution", "cc", "creative commons"),
    ("all rights reserved", "all-rights-reserved", ""),
]
#: Whole public notices, their labels, and words that must stand in them.
NOTICES = [
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
    persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
    this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
    "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
    FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
    CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
    CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "mit", ""),
    ("""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution.""", "bsd", "redistributions in binary form"),
    ("""Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
    derived from this software without specific prior written permission.""", "bsd-3-clause", "endorse or promote"),
    ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
    the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
    applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
    WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
    permissions and limitations under the License.""", "apache-2.0", "apache license"),
    ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
    version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
    warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
    should have received a copy of the GNU General Public License along with this program.""", "gpl", "gnu general public license"),
    ("""This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
    Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
    later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more
    details. You should have received a copy of the GNU Lesser General Public License along with this library.""", "lgpl",
     "gnu lesser general public license"),
    ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
    Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
    version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
    warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.
    You should have received a copy of the GNU Affero General Public License along with this program.""", "agpl",
     "gnu affero general public license"),
    ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
    distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "mpl", "mozilla public license"),
    ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
    provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
    AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
    WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
    ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", "isc", "with or without fee"),
    ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
    compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
    or non-commercial, and by any means.""", "unlicense", "public domain"),
    ("""You must give appropriate credit, provide a link to the license, and indicate if changes were made. You may do so in any
    reasonable manner, but not in any way that suggests the licensor endorses you or your use.""", "cc", "appropriate credit"),
    ("""If you remix, transform, or build upon the material, you must distribute your contributions under the same license as
    the original.""", "cc-by-sa", "the same license"),
    ("You may not use the material for commercial purposes.", "cc-by-nc", "commercial purposes"),
    ("If you remix, transform, or build upon the material, you may not distribute the modified material.", "cc-by-nd",
     "may not distribute"),
]
#: Everything that is looked for; its place here is a template's number.
SOUGHT = [*((text, label, "") for text, label in PHRASES), *TEMPLATES, *NOTICES]
#: Diagonals this near are one alignment; a span needs this share of the template's grams, and of its words in order.
BAND = 3
COVER = 0.6


def template_grams(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Templates (tpl, label, phrase, k, n_grams), and their grams (tpl, k, key, tpos)."""
    templates, grams = [], []
    for tpl, (text, label, _) in enumerate(SOUGHT):
        h, n = shingles.hashed_words([text.encode()], GAPS)
        k = SHORT if tpl < len(PHRASES) or len(h) <= LONG else LONG
        keys, _, places = shingles.rolling(h, n, k)
        templates.append((tpl, label, tpl < len(PHRASES), k, len(keys)))
        grams += [(tpl, k, int(key), int(at)) for key, at in zip(keys.view(np.int64), places, strict=True)]
    return (spark.createDataFrame(templates, "tpl int, label string, phrase boolean, k int, n_grams int"),
            spark.createDataFrame(grams, "tpl int, k int, key long, tpos int"))


def grams(docs: DataFrame) -> DataFrame:
    """(row, doc_id, k, pos, key): every gram of every text, and with k = 0 each document's number of words as pos, its text's hash as key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc_id, text_hash = batch.column("row"), batch.column("doc_id"), batch.column("text_hash").to_numpy()
            h, counts = shingles.hashed_words([t.encode() for t in batch.column("text").to_pylist()], GAPS)
            every = [(0, text_hash.view(np.uint64), np.arange(len(counts)), counts)]
            every += [(k, *shingles.rolling(h, counts, k)) for k in (SHORT, LONG)]
            for k, keys, of, places in every:
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [row.take(at), doc_id.take(at), pa.array(np.full(len(of), k, np.int32)), pa.array(places.astype(np.int32)),
                     pa.array(keys.view(np.int64))], ["row", "doc_id", "k", "pos", "key"])

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.xxhash64(plain_text()).alias("text_hash"),
                        plain_text().alias("text"))
    return texts.mapInArrow(run, "row long, doc_id long, k int, pos int, key long")


def hits(docs: DataFrame) -> DataFrame:
    """Written table (row, doc_id, k, pos, key, tpl, tpos) of gram hits, and of each document's number of words and text hash (k = 0)."""
    ship(docs.sparkSession)
    _, template = template_grams(docs.sparkSession)
    found = grams(docs).join(F.broadcast(template), ["k", "key"], "left")  # the given templates only
    return written(found.filter((F.col("k") == 0) | F.col("tpl").isNotNull()).select("row", "doc_id", "k", "pos", "key", "tpl", "tpos"),
                   "gram-hits", TEXT_ROWS)


def stretches(hits: list[tuple[int, int]], k: int, most: int, least: float) -> list[tuple[int, int, int]]:
    """(start, end, grams) of stretches without overlap of at most ``most`` words with ``least`` different grams or more.

    ``hits`` are sorted (pos, tpos).  Each stretch starts and ends with a hit.
    """
    found = []
    for i, (start, _) in enumerate(hits):
        seen, end = set(), start
        for j in range(i, len(hits)):
            pos, tpos = hits[j]
            if pos + k - start > most:
                break
            if tpos not in seen:
                seen.add(tpos)
                end = pos + k
        if len(seen) >= least:
            found.append((-len(seen), end - start, start))
    first = hits[0][0] if hits else 0
    taken = np.zeros(hits[-1][0] + k - first if hits else 0, bool)
    out = []
    for n, length, start in sorted(found):
        place = slice(start - first, start - first + length)
        if not taken[place].any():
            taken[place] = True
            out.append((start, start + length, -n))
    return sorted(out)


def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged spans within the allowed length as they are, longer ones in stretches."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["hits"] is None:
                out.append((r["row"], r["tpl"], r["label"], r["phrase"], r["start"], r["end"], r["score"]))
                continue
            hits = [(h["pos"], h["tpos"]) for h in r["hits"]]
            out += [(r["row"], r["tpl"], r["label"], r["phrase"], a, b, n / r["n_grams"])
                    for a, b, n in stretches(hits, r["k"], r["longest"], COVER * r["n_grams"])]
        names = ["row", "tpl", "label", "phrase", "start", "end", "score"]
        types = [pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate(types)], names)


def spans(found: DataFrame, templates: DataFrame) -> DataFrame:
    """(row, tpl, label, phrase, start, end, score): base places, and merged spans of templates with their share of grams."""
    votes = (found.filter("k > 0").withColumn("diagonal", F.col("pos") - F.col("tpos"))
             .groupBy("row", "tpl", "diagonal").agg(F.sort_array(F.collect_set("tpos")).alias("seen")))
    known = votes.join(F.broadcast(templates), "tpl")
    full = known.filter(F.col("phrase") & (F.size("seen") == F.col("n_grams"))).select(
        "row", "tpl", "label", "phrase", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("n_grams") + F.col("k") - 1).alias("end"), F.lit(1.0).alias("score"))
    by_place = Window.partitionBy("row", "tpl").orderBy("diagonal")
    merged = (
        known.filter(~F.col("phrase"))
        .withColumn("new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_place) > BAND, F.lit(True)).cast("int"))
        .withColumn("group", F.sum("new").over(by_place))
        .groupBy("row", "tpl", "label", "phrase", "n_grams", "k", "group")
        .agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"),
             F.min(F.col("diagonal") + F.col("seen")[0]).alias("start"),
             F.max(F.col("diagonal") + F.element_at("seen", -1) + F.col("k")).alias("end"),
             F.collect_list(F.struct("diagonal", "seen")).alias("votes"))
        .withColumn("score", F.size("seen") / F.col("n_grams"))
        .withColumn("longest", F.col("n_grams") + F.col("k") + 2 * BAND)
    )
    places = F.flatten(F.transform("votes", lambda v: F.transform(
        v["seen"], lambda t: F.struct((v["diagonal"] + t).alias("pos"), t.alias("tpos")))))
    enough = merged.filter(F.col("score") >= COVER).select(  # no part has more grams than the whole
        "row", "tpl", "label", "phrase", "start", "end", "score", "n_grams", "k", "longest",
        F.when(F.col("end") - F.col("start") > F.col("longest"), F.sort_array(places)).alias("hits"))
    good = enough.mapInArrow(split, "row long, tpl int, label string, phrase boolean, start int, end int, score double")
    return full.unionByName(good)


def text_words(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


def in_order(found: list[bytes], template: list[bytes]) -> int:
    """Length of the longest common subsequence; bit i of ``rest`` falls when template word i adds to it."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(template):
        places[word] = places.get(word, 0) | 1 << i
    rest = every = (1 << len(template)) - 1
    for word in found:
        hit = rest & places.get(word, 0)
        rest = ((rest + hit) | (rest - hit)) & every
    return len(template) - rest.bit_count()


def holds(found: list[bytes], template: list[bytes], must: list[bytes], phrase: bool) -> bool:
    """Whether the words of a span bear the template out: a phrase word by word, others by share and needed words."""
    if found == template:
        return True
    if phrase or in_order(found, template) < COVER * len(template):
        return False
    return not must or any(found[i : i + len(must)] == must for i in range(len(found) - len(must) + 1))


def verified(docs: DataFrame, found: DataFrame, proposed: DataFrame) -> DataFrame:
    """Written table (text, label, phrase, start, end, score) of the spans whose words hold; text is (doc_id, text_hash).

    Texts are moved at most once, to meet the spans proposed for them; equal rows are read as one.
    """
    templates = [(text_words(text), text_words(must), tpl < len(PHRASES)) for tpl, (text, _, must) in enumerate(SOUGHT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, kept = [], []
            for i, text in enumerate(batch.column("body").to_pylist()):
                w = text_words(text)
                for s in batch.column("spans")[i].as_py():
                    if holds(w[s["start"] : s["end"]], *templates[s["tpl"]]):
                        of.append(i)
                        kept.append(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("text").take(pa.array(of, pa.int64())), *[pa.array([s[n] for s in kept], t) for n, t in fields]],
                ["text", *[n for n, _ in fields]])

    fields = [("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    key = F.struct("doc_id", "text_hash").alias("text")
    rows = found.filter("k = 0").select("row", F.struct("doc_id", F.col("key").alias("text_hash")).alias("text"))
    by_text = proposed.join(rows, "row").groupBy("text").agg(
        F.collect_set(F.struct("tpl", "label", "phrase", "start", "end", "score")).alias("spans"))
    texts = (docs.select(F.col("doc_id").cast("long"), F.xxhash64(plain_text()).alias("text_hash"), plain_text().alias("body"))
             .select(key, "body").join(by_text.select("text"), "text", "left_semi")
             .groupBy("text").agg(F.min("body").alias("body")))
    checked = texts.join(by_text, "text").mapInArrow(
        run, "text struct<doc_id: bigint, text_hash: bigint>, label string, phrase boolean, start int, end int, score double")
    return written(checked, "license-spans", TEXT_ROWS)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels and score."""
    found = hits(docs)
    templates, _ = template_grams(docs.sparkSession)
    proposed = written(spans(found, templates), "proposed-spans")
    base = F.col("phrase")
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    by_doc = verified(docs, found, proposed).groupBy("text").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans"))
    docs_only = found.filter("k = 0").select(
        F.struct("doc_id", F.col("key").alias("text_hash")).alias("text"), F.col("pos").cast("long").alias("n_words"))
    return docs_only.join(by_doc, "text", "left").select(
        "text.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))
