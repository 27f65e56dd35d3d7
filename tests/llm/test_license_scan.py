"""The license scan against containment computed at every place of every text."""

import random
import re

from shredloom.llm import license_scan
from shredloom.llm.common import table
from shredloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def grams(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [tuple(words[k:k + 3]) for k in range(len(words) - 2)]


PATTERNS = [(name, set(grams(text))) for name, texts in license_scan.TEMPLATES.items()
            for text in texts]


def brute_force(text):
    """(license, share, place) of the best place of each license, worse ones at one place left out."""
    h, best = grams(text), {}
    for name, wanted in PATTERNS:
        hits = [k for k, gram in enumerate(h) if gram in wanted]
        for k in hits:
            inside = [p for p in hits if k <= p < k + 2 * len(wanted) + license_scan.WINDOW]
            share = len({h[p] for p in inside}) / len(wanted)
            if share >= license_scan.MIN_CONTAINMENT:
                best[name] = max(best.get(name, (0, 0)), (share, -k))
    return {name for name, (share, at) in best.items() if not any(
        other != name and more > share and abs(there - at) <= license_scan.SAME_PLACE
        for other, (more, there) in best.items())}


def compare(found, texts):
    """Licenses found that are not there, and the share of those there that were found."""
    got, want = set(found), {(doc, name) for doc, text in texts.items() for name in brute_force(text)}
    return got - want, len(got & want) / len(want)


def test_documents_of_the_table(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    found = [(r.doc_id, r.license) for r in QUERIES["op6_license_scan"](spark, SF).collect()]
    assert compare(found, texts) == (set(), 1.0)


def test_damaged_notices_inside_other_text(spark):
    """Every template with up to three words changed, left out or put in, among 50 to 300 others."""
    draw, texts = random.Random(6), {}
    notices = [text for listed in license_scan.TEMPLATES.values() for text in listed]
    for doc in range(1_200):
        words = notices[doc % len(notices)].split()
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            at = draw.randrange(len(words))
            words[at:at + draw.choice([0, 1])] = draw.choice([[], [f"new{doc}"]])
            words = words or ["none"]
        noise = [f"w{draw.randrange(60)}" for _ in range(draw.randint(50, 300))]
        at = draw.randrange(len(noise))
        texts[doc] = " ".join(noise[:at] + words + noise[at:])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    extra, recall = compare(
        [(r.doc_id, r.license) for r in license_scan.scan_licenses(docs).collect()], texts)
    assert extra == set() and recall >= 0.99


def test_the_license_that_fits_best_is_named(spark):
    cases = {
        1: ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL"]),
        2: ("This program is free software: you can redistribute it and/or modify it under the terms "
            "of the GNU Affero General Public License as published by the Free Software Foundation",
            ["AGPL-3.0"]),
        3: ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        4: ("SPDX-License-Identifier: CC-BY-SA-4.0", ["CC-BY-SA-4.0"]),
        5: ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. " * 2
            + "Unrelated words follow here and go on for a while. Licensed under CC BY 4.0.",
            ["CC-BY-4.0"]),
        6: ("SPDX-License-Identifier: LicenseRef-Own", []),
        7: ("This work is licensed under the GNU Affero General Public License, version 3. Parts of it "
            "came from elsewhere. This work is licensed under the GNU General Public License, version 3.",
            ["AGPL-3.0", "GPL-3.0"]),
    }
    docs = spark.createDataFrame([(k, text) for k, (text, _) in cases.items()], "doc_id long, text string")
    got = {k: [] for k in cases}
    for row in license_scan.scan_licenses(docs).collect():
        got[row.doc_id].append(row.license)
    assert {k: sorted(v) for k, v in got.items()} == {
        k: sorted(set(want) | brute_force(cases[k][0])) for k, (_, want) in cases.items()}
