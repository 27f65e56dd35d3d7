"""Columns of the input that are named like an operator's own helpers keep their values."""

import ast
import inspect

import pytest
from pyspark.sql import functions as F

from shredloom.llm import common, license_scan, line_dedup, mixing, quality
from shredloom.llm.common import words

TEXT = " ".join(f"Plain{i} words{i} number{i} make{i} a line." for i in range(12))
RUN = {
    "line_dedup": (line_dedup, lambda d: line_dedup.dedup_lines(d, min_pages=1)),
    "license_scan": (license_scan, lambda d: license_scan.scan_licenses(d)),
    "mixing": (mixing, lambda d: mixing.mix(d, F.size(words(F.col("text"))))),
    "quality": (quality, lambda d: quality.quality_rules(d)),
}


def helper_names(*modules):
    """The strings of a module's code that can be column names with an underscore in front."""
    found = set()
    for module in modules:
        for node in ast.walk(ast.parse(inspect.getsource(module))):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                name = node.value.split(".")[0]
                if name.isidentifier() and name[0] == "_" and name != "__main__":
                    found.add(name)
    return sorted(found | {"in0", "in1", "in2", "in9"})


@pytest.mark.parametrize("name", sorted(RUN))
def test_helper_names_of_the_input_survive(spark, name):
    module, run = RUN[name]
    mine = helper_names(module, common)
    assert len(mine) > 5
    docs = spark.createDataFrame(
        [(1, TEXT + " All rights reserved.", "a"), (2, TEXT, "a"), (3, None, None)],
        "doc_id long, text string, source string")
    plain = {r.doc_id: r for r in run(docs).collect()}
    clashing = docs.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in mine])
    rows = run(clashing).collect()
    assert {r.doc_id for r in rows} == set(plain) and rows
    for r in rows:
        for n in mine:
            assert r[n] == f"{n} {r.doc_id}"
        for c in plain[r.doc_id].asDict():
            assert r[c] == plain[r.doc_id][c]


def test_empty_documents_of_a_full_source_stay_within_the_epochs(spark):
    rows = [(1, "a", 0), (2, "a", 10), (3, "b", 1000), (4, "b", 0), (5, "c", 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = mixing.mix(docs, F.col("words"), cycle=(50, 1)).collect()
    assert max(r.repeats for r in got) <= 3
    assert {r.doc_id: r.taken for r in got}[2] == 30
