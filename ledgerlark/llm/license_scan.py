"""License scan with a positional index of rare words, in DataFrame functions only.

Document frequencies of all template words are counted over the whole table. Of each template the index holds, with their positions, its
highest-IDF words, as many as make up more weight than a place may lack, and two words of its mandatory key phrase. A file's
indexed words are looked up: templates none of whose highest-IDF words the file has are out. A posting and the place of its word in the
file give the place where the template would begin; the places that both key words' postings agree on are intersected with those that a
highest-IDF word gives. No place is lost so: one that holds has the key phrase, and without all of the highest-IDF words it would lack
too much weight. At what is left the key phrase is verified word by word and the agreeing words' IDF weight summed. Beside that, all
places of the base phrases are counted.

The scan needs no shuffle: whatever it finds is found within one row. The frequency count sends one row
a template word and task.

Defined results: a null text counts as empty: no words, no places, null first_word and last_word, empty
label lists and score 0; words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters; repeated rows are scanned alike; other input columns are left out; no documents give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: label -> words that must stand consecutively: the base
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
#: label, template words, mandatory key phrase (part of the template)
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license", "general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    # Whole notices.
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
        " persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the software",
        "permission is hereby granted free of charge",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
        " redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
        " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"
        " and or other materials provided with the distribution",
        "redistribution and use in source and binary forms",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is"
        " basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
        " either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without"
        " even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "general public license",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this"
        " permission notice appear in all copies",
        "permission to use copy modify",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "mozilla public license",
    ),
]
#: The share of a template's IDF weight that must agree at a place.
AGREE = 0.5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in lower case. Case of non-ASCII letters is mapped too, which neither joins nor parts words nor makes a phrase's word."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lowered, NOT_WORD, -1), lambda w: w != "")


def frequencies(docs: DataFrame, templates=None) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each template word: as many rows as template words."""
    vocabulary = sorted({w for _, t, _ in (templates or TEMPLATES) for w in t.split()})
    has = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary))))).alias("word"))
    found = {r["word"]: r["n"] for r in has.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return found.get("", 0), {w: found.get(w, 0) for w in vocabulary}


def key_place(parts: list[str], key: list[str]) -> int:
    """Where a template's key phrase begins."""
    return next(k for k in range(len(parts)) if parts[k : k + len(key)] == key)


def postings(template: tuple[str, str, str], idf: dict[str, float]) -> tuple[list[int], list[int]]:
    """(positions of the highest-IDF words, of two key words): the first make up more than the weight that a place may lack."""
    _, text, key = template
    parts, key_words = text.split(), key.split()
    by_rarity = sorted(range(len(parts)), key=lambda k: (-idf[parts[k]], k))
    spare, heavy = (1 - AGREE) * sum(idf[w] for w in parts), []
    while sum(idf[parts[k]] for k in heavy) <= spare * (1 + 1e-9):
        heavy.append(by_rarity[len(heavy)])
    first = key_place(parts, key_words)
    return heavy, sorted(range(first, first + len(key_words)), key=lambda k: (-idf[parts[k]], k))[:2]


def starts_at(words: Column, start: Column, phrase: list[str]) -> Column:
    """Whether the phrase's words stand at a place; places before the first word hold nothing."""
    held = start >= 0
    for k, w in enumerate(phrase):
        held = held & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    return held


def scan(docs: DataFrame, templates=None, base: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; and n_places of the templates."""
    templates, base = templates or TEMPLATES, base or BASE
    total, df = frequencies(docs, templates)
    idf = {w: math.log((total + 1) / (n + 1)) + 1e-3 for w, n in df.items()}
    index = [postings(t, idf) for t in templates]
    indexed = {t[1].split()[k] for t, (heavy, keys) in zip(templates, index, strict=True) for k in (*heavy, *keys)}
    phrases = {label: p.split() for label, p in base.items()}
    lasts = {p[-1] for p in phrases.values()}
    wanted = sorted({*indexed, *lasts})

    split = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    spotted = split.select(
        "doc_id",
        "words",
        F.filter(F.transform("words", lambda w, i: F.when(w.isin(wanted), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull()).alias("hits"),
    )
    words = F.col("words")

    def base_places(h: Column) -> Column:
        found = F.array().cast("array<struct<label:string,at:int>>")
        for label, p in phrases.items():
            at = h["i"] - (len(p) - 1)
            held = (h["w"] == p[-1]) & starts_at(words, at, p)
            found = F.when(held, F.array(F.struct(F.lit(label).alias("label"), at.alias("at")))).otherwise(found)
        return found

    hits = F.col("hits")

    def begins(positions: dict[str, list[int]]) -> Column:
        """Places where a template would begin, by the words that stand at some of its positions."""
        table = F.create_map(*(x for w, at in positions.items() for x in (F.lit(w), F.array(*map(F.lit, at)))))
        mine = F.filter(hits, lambda h: h["w"].isin(*positions))
        return F.flatten(F.transform(mine, lambda h: F.transform(table[h["w"]], lambda at: h["i"] - at)))

    def places_of(t: int) -> Column:
        """(label, score) of a template's places: postings intersected, key phrase verified, weight summed."""
        label, text, key = templates[t]
        parts, key_words, (heavy, keys) = text.split(), key.split(), index[t]
        rare: dict[str, list[int]] = {}
        for k in heavy:
            rare.setdefault(parts[k], []).append(k)
        both = begins({parts[keys[0]]: [keys[0]]})
        for k in keys[1:]:
            both = F.array_intersect(both, begins({parts[k]: [k]}))
        at = F.filter(F.array_intersect(both, begins(rare)), lambda start: starts_at(words, start + key_place(parts, key_words), key_words))
        weights, weight = F.array(*(F.lit(idf[p]) for p in parts)), sum(idf[p] for p in parts)
        said = F.array(*map(F.lit, parts))

        def agreed(start: Column) -> Column:
            same = lambda k: F.coalesce((start + k >= 0) & (F.get(words, start + k) == F.get(said, k)), F.lit(False))
            return F.aggregate(F.sequence(F.lit(0), F.lit(len(parts) - 1)), F.lit(0.0), lambda acc, k: acc + F.when(same(k), F.get(weights, k)).otherwise(0.0)) / weight

        scored = F.transform(at, lambda start: F.struct(F.lit(label).alias("label"), agreed(start).alias("score")))
        held = F.transform(F.filter(scored, lambda p: p["score"] >= AGREE), lambda p: F.struct(p["label"].alias("label"), F.round(p["score"], 6).alias("score")))
        # A file without any of the template's highest-IDF words has no place of it.
        return F.when(F.arrays_overlap(F.col("known"), F.array(*map(F.lit, rare))), held).otherwise(F.array().cast("array<struct<label:string,score:double>>"))

    some = F.size("hits") > 0
    placed = spotted.withColumn("known", F.array_distinct("hits.w")).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(some, F.flatten(F.transform("hits", base_places))).otherwise(F.array().cast("array<struct<label:string,at:int>>")).alias("base"),
        F.when(some, F.concat(*(places_of(t) for t in range(len(templates))))).otherwise(F.array().cast("array<struct<label:string,score:double>>")).alias("places"),
    )
    base_labels = F.array_distinct(F.col("base.label"))
    return placed.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"),
        F.array_max("base.at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("places.label"))), ",").alias("labels"),
        F.coalesce(F.array_max("places.score"), F.lit(0.0)).alias("score"),
        F.size("places").cast("long").alias("n_places"),
    )
