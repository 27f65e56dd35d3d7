"""License notices inside texts, in built-in functions only.

Overlapping windows of word shingles are hashed to one minimum per band; a window that shares a
minimum with a piece of a template retrieves the template, and the exact share of the
template's shingles around that place decides.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import numbered, without

# Short notices and passages of public licenses.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "may be used to endorse or promote products derived from this software without specific "
        "prior written permission",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC0-1.0": [
        "CC0 1.0 Universal",
        "has dedicated the work to the public domain by waiving all of his or her rights to the "
        "work worldwide under copyright law",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "All-rights-reserved": ["All rights reserved."],
}
# Identifiers in source file tags, by license.
TAG = "SPDX-License-Identifier: "
TAGGED = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache-2.0"], "GPL-3.0": ["GPL-3.0"],
    "LGPL": ["LGPL-2.1", "LGPL-3.0"], "AGPL-3.0": ["AGPL-3.0"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "ISC": ["ISC"], "Zlib": ["Zlib"],
    "EPL-2.0": ["EPL-2.0"], "MPL-2.0": ["MPL-2.0"], "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0-1.0"], "CC-BY-4.0": ["CC-BY-4.0"], "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
}
for _name, _ids in TAGGED.items():
    TEMPLATES[_name] += [TAG + _id for _id in _ids]

SHINGLE = 3          # words; notices are too short for more
WINDOW, STEP = 8, 4  # shingles of a text window, and between the starts of two
PIECE = WINDOW - STEP + 1  # any run of so many shingles lies inside one window
BANDS = 14           # one minimum each: a piece of 3 shingles is met with 1 - (5/8)^14 > 99.8 %
SHORT = 2            # templates of so few shingles are compared one shingle at a time
MIN_CONTAINMENT = 0.8
SAME_PLACE = 8       # words between the starts of two matches of one notice


def word_split(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: str) -> Column:
    """Hashes of the 3-word shingles of an array column, in order."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - SHINGLE + 1, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)))


def band_masks(bands: int = BANDS, seed: int = 6) -> list[int]:
    """One mask per band: the order of the hashes after XOR is that band's permutation."""
    draw = random.Random(seed)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(bands)]


def template_shingles(spark, templates: dict[str, list[str]]) -> list[tuple[str, list[int]]]:
    """(license, shingle hashes) of each template, hashed by Spark so that they agree."""
    rows = [(name, text) for name, texts in templates.items() for text in texts]
    hashed = spark.createDataFrame(rows, "name string, text string").withColumn(
        "words", word_split(F.col("text"))).select("name", shingle_hashes("words").alias("h"))
    found = [(row.name, list(row.h)) for row in hashed.collect()]
    if any(not h for _, h in found):
        raise ValueError(f"a template needs {SHINGLE} words")
    return found


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None,
                  text: str = "text", min_containment: float = MIN_CONTAINMENT,
                  bands: int = BANDS) -> DataFrame:
    """One row per document and license found: the other columns of the document, `license`,
    `containment` (of its best template) and `word_at` (place of the first word looked at).

    Of licenses found at one place those that fit less than another are left out.
    Null, empty and very short texts have no shingle and give no row. Very long texts are read
    whole. Repeated rows are reported each. Columns named as those added are replaced. All work
    is done within each row: nothing is shuffled. Templates are few, of fixed size, and held as
    literals.
    """
    known = template_shingles(docs.sparkSession, templates or TEMPLATES)
    masks = F.array(*[F.lit(mask) for mask in band_masks(bands)])
    keys = [template_keys(h, bands) for _, h in known]
    wide = sorted({key for (_, h), own in zip(known, keys) if len(h) > SHORT for key in own})
    single = sorted({key for (_, h), own in zip(known, keys) if len(h) <= SHORT for key in own})

    docs = without(docs, ("license", "containment", "word_at"))
    names = numbered(docs)
    docs, kept, text = docs.toDF(*names.values()), [c for c in names if c != text], names[text]
    rest = [names[c] for c in kept]
    hashed = docs.select(*rest, word_split(F.col(text)).alias("_words")).select(
        *rest, shingle_hashes("_words").alias("_h"))

    def shares_minimum(window: Column, wanted: list[int]) -> Column:
        return F.exists(masks, lambda mask: F.array_min(F.transform(
            window["shingles"], lambda x: x.bitwiseXOR(mask))).isin(*wanted))

    def starts(step: int) -> Column:
        return F.when(F.size("_h") > 0, F.sequence(
            F.lit(0), F.size("_h") - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))

    windows = F.transform(starts(STEP), lambda at: F.struct(
        at.alias("at"), F.slice("_h", at + 1, F.lit(WINDOW)).alias("shingles")))
    retrieved = hashed.withColumns({
        "_wide": F.filter(windows, lambda window: shares_minimum(window, wide))
        if wide else F.filter(windows, lambda window: F.lit(False)),
        "_single": F.filter(starts(1), lambda at: F.get("_h", at).isin(*single))
        if single else F.array().cast("array<int>"),
    })

    def best_place(h: list[int], own: list[int]) -> Column:
        if len(h) > SHORT:
            places = F.transform(F.filter(
                "_wide", lambda window: shares_minimum(window, own)), lambda window: window["at"])
        else:
            places = F.filter("_single", lambda at: F.get("_h", at).isin(*own))
        return F.array_max(F.transform(places, lambda at: compared(at, h)))

    # Each template is compared where one of its own pieces was met: in few documents.
    matches = []
    for (name, h), own in zip(known, keys):
        best = best_place(h, sorted(own))
        matches.append(F.when(best["containment"] >= min_containment, F.struct(
            F.lit(name).alias("license"), best["containment"].alias("containment"),
            (-best["before"]).alias("word_at"))))
    found = F.sort_array(F.array_compact(F.array(*matches)), asc=False)
    # Licenses of one family differ by a word: what is there is the one that fits best.
    best_fits = F.filter(F.col("_all"), lambda x: ~F.exists(F.col("_all"), lambda y: (
        y["license"] != x["license"]) & (y["containment"] > x["containment"]) & (
        F.abs(y["word_at"] - x["word_at"]) <= SAME_PLACE)))
    first_of_license = F.filter(F.col("_found"), lambda x, i: (i == 0) | (
        F.get("_found", i - 1)["license"] != x["license"]))
    # The outer form, so that no filter on the array moves below and computes it again.
    return retrieved.select(*rest, found.alias("_all")).select(
        *rest, best_fits.alias("_found")).select(
        *rest, F.explode_outer(first_of_license).alias("_match")).where(
        F.col("_match").isNotNull()).select(
        *rest, "_match.license", "_match.containment",
        F.col("_match.word_at").cast("long").alias("word_at")
    ).toDF(*kept, "license", "containment", "word_at")


def template_keys(h: list[int], bands: int = BANDS) -> set[int]:
    """What a text window must share: minima of the template's pieces, or its few shingles."""
    if len(h) <= SHORT:
        return set(h)
    return {min(value ^ mask for value in h[start:start + PIECE])
            for start in range(max(len(h) - PIECE, 0) + 1) for mask in band_masks(bands)}


def compared(at: Column, h: list[int]) -> Column:
    """Share of the template's shingles around a place, and the first one's place, negated."""
    start = F.greatest(at - len(set(h)), F.lit(0))
    around = F.slice("_h", start + 1, F.lit(2 * len(set(h)) + WINDOW))
    wanted = F.array(*[F.lit(value) for value in sorted(set(h))])
    places = F.filter(F.transform(around, lambda x, i: F.when(
        x.isin(*sorted(set(h))), start + i)), lambda i: i.isNotNull())
    return F.struct(
        (F.size(F.array_intersect(around, wanted)) / F.lit(float(len(set(h))))).alias(
            "containment"), (-F.array_min(places)).alias("before"))
