"""License scans: MinHash bands over text windows, then exact containment.

Texts and templates are word runs (letters lower-cased); shingles are five words.
Templates are put in classes by length. For each class a text is cut into
overlapping windows in which any passage of that length lies whole, and every
window gets ``BANDS`` independent MinHash values of one row each. A template
that holds at least ``CONTAINED`` of its shingles in a window shares a band with
probability 1 - (1 - J)**BANDS, where J is bounded below by the class's lengths
(``collision_bound``: over 99.9 % for every class). Templates fetched by a
band are verified by exact shingle containment; licences whose notices differ in a
word or two (GPL, LGPL, AGPL, and their versions) by these words as well.

Only windows that can match are hashed: for each template a few of its words
are chosen so that shingles without any of them are too few to reach
``CONTAINED``; a window with none of these words cannot match. SQL functions
only; templates are a parameter of fixed size.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.columns import token_words

SHINGLE, CONTAINED, BANDS = 5, 0.8, 64

#: Notices that the default scan looks for.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ("version 3",)),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
     ("gnu general public license", "version 3")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
     ("gnu affero general public license", "version 3")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
                     "this software without specific prior written permission."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "This work is marked with CC0 1.0 Universal."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
     ("gnu general public license", "version 2 of")),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
     ("gnu lesser general public license", "version 2 1")),
    ("lgpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version.",
     ("gnu lesser general public license", "version 3")),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    *((name.lower(), f"SPDX-License-Identifier: {name}") for name in (
        "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
        "LGPL-3.0", "MPL-2.0")),
)


@dataclass(frozen=True)
class Template:
    number: int
    license: str
    words: tuple[str, ...]
    marks: tuple[str, ...] = ()

    @property
    def shingles(self) -> set[tuple[str, ...]]:
        n = len(self.words)
        return {self.words[i: i + SHINGLE] for i in range(max(1, n - SHINGLE + 1))}


def prepared(templates) -> list[Template]:
    """Word runs of (license, text) pairs; those of under five words are refused.
    A third value names runs of words that tell a licence from its relatives."""
    out = []
    for name, text, *marks in templates:
        words = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        if len(words) < SHINGLE:
            raise ValueError(f"template of under {SHINGLE} words: {text!r}")
        out.append(Template(len(out), name, words, tuple(*marks)))
    return out


def size_class(n_words: int) -> int:
    """Classes 8, 16, 32, ...: the longest passage of the class in words, with an allowance for changed words."""
    return max(8, 1 << math.ceil(math.log2(n_words)))


def window_shape(cls: int) -> tuple[int, int]:
    """Words in a window of the class, and between window starts."""
    step = max(2, cls // 4)
    return cls + step - 1 + cls // 4, step


def collision_bound(template: Template, bands: int = BANDS) -> float:
    """Least probability that a window holding the template is retrieved."""
    length, _ = window_shape(size_class(len(template.words)))
    shared = math.ceil(CONTAINED * len(template.shingles))
    union = (length - SHINGLE + 1) + len(template.shingles) - shared
    return 1 - (1 - shared / union) ** bands


def anchor_words(template: Template, common: dict[str, int]) -> set[str]:
    """Words, the longest first (which other text rarely holds), such that the
    shingles without any of them fall short of ``CONTAINED``."""
    left, chosen = set(template.shingles), set()
    for word in sorted(set(template.words), key=lambda w: (-len(w), common.get(w, 0), w)):
        if len(left) < CONTAINED * len(template.shingles):
            break
        chosen.add(word)
        left = {s for s in left if word not in s}
    return chosen


def _shingle_hashes(words: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(words, i, SHINGLE))))


def _bands(hashes: Column) -> Column:
    """MinHash values, tied to their band."""
    def band(b: int) -> Column:
        return F.xxhash64(F.lit(b), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(b)))))

    return F.array(*map(band, range(BANDS)))


def _useful_windows(cls: int, anchors: list[str]) -> Column:
    """Windows of a class that hold an anchor word."""
    length, step = window_shape(cls)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - SHINGLE, F.lit(0)), F.lit(step))
    cut = F.transform(starts, lambda i: F.struct(F.lit(cls).alias("cls"), i.alias("at"), F.slice("_words", i + 1, F.lit(length)).alias("words")))
    return F.filter(cut, lambda w: (F.size(w["words"]) >= SHINGLE) & F.arrays_overlap(w["words"], F.array(*map(F.lit, anchors))))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tag (hash of the text), license, template (its number), n_shingles
    (of the template), n_found (most of them in one window), first_word (least
    start of a window that matches), one row per text and matching template.

    A template matches where one window holds at least 80 % of its shingles and
    every run of words that the template names as its own.
    Null, empty and shorter texts match nothing. Repeated rows give one row;
    rows with a null id are scanned like others.
    """
    spark = docs.sparkSession
    known = prepared(templates)
    common: dict[str, int] = {}
    for t in known:
        for w in set(t.words):
            common[w] = common.get(w, 0) + 1
    anchors = {t.number: anchor_words(t, common) for t in known}
    every = sorted(set().union(*anchors.values())) if known else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"), F.col(text_col).alias("_text"))
    marks = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    # The rule of words, without cutting them out: one expression over the text.
    pattern = f"(?:^|{marks})(?:{'|'.join(_either_case(w) for w in every)})(?:{marks}|$)"
    rows = rows.where(F.col("_text").rlike(pattern)) if every else rows.limit(0)
    rows = rows.distinct().withColumn("_words", token_words(F.col("_text"))).where(F.size("_words") >= SHINGLE)
    kept = sorted({size_class(len(t.words)) for t in known})
    shapes = [_useful_windows(cls, sorted(set().union(*(anchors[t.number] for t in known if size_class(len(t.words)) == cls)))) for cls in kept]
    empty = "doc_id {0}, tag long, license string, template int, n_shingles int, n_found int, first_word int".format(docs.schema[id_col].dataType.simpleString())
    if not shapes:
        return spark.createDataFrame([], empty)
    windows = rows.select("doc_id", "tag", F.explode(F.concat(*shapes)).alias("_w")).select("doc_id", "tag", "_w.cls", "_w.at", "_w.words")
    windows = windows.withColumn("_hashes", _shingle_hashes(F.col("words"))).withColumn("_bands", _bands(F.col("_hashes")))
    marks_of_all = sorted({m for t in known for m in t.marks})
    run = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    windows = windows.withColumn("_marks", F.array_compact(F.array(*(F.when(run.contains(f" {m} "), F.lit(m)) for m in marks_of_all))).cast("array<string>"))
    probes = windows.select("doc_id", "tag", "cls", "at", F.col("_hashes"), "_marks", F.explode(F.array_distinct("_bands")).alias("_band"))
    table = spark.createDataFrame([(t.number, t.license, size_class(len(t.words)), list(t.words), list(t.marks)) for t in known],
                                  "template int, license string, cls int, words array<string>, _needed array<string>")
    table = table.withColumn("_own", _shingle_hashes(F.col("words"))).withColumn("_band", F.explode(F.array_distinct(_bands(F.col("_own"))))).drop("words")
    pairs = probes.join(F.broadcast(table), ["cls", "_band"])  # templates x BANDS rows, a parameter's size
    n_found = F.size(F.array_intersect("_hashes", "_own"))
    pairs = pairs.where(F.size(F.array_except("_needed", "_marks")) == 0)
    found = pairs.select("doc_id", "tag", "license", "template", F.size("_own").alias("n_shingles"), n_found.alias("n_found"), F.col("at"))
    found = found.where(F.col("n_found") >= CONTAINED * F.col("n_shingles"))
    return found.groupBy("doc_id", "tag", "license", "template", "n_shingles").agg(
        F.max("n_found").alias("n_found"), F.min("at").alias("first_word"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) for c in word)
