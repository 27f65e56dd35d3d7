"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, by operator."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shredloom.llm import (
    bpe, embedding_dedup, html_blocks, html_text, license_scan, line_dedup, mixing, ngram_join,
    quality, sharding, shingles, token_counts)
from shredloom.llm.common import words
from shredloom.llm.queries import tokenizers
from shredloom.llm.vocabulary import read_ranks

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i} and" for i in range(20_000)) + "."
PROSE = " ".join(f"Plain{i} words{i} number{i} make{i} a line." for i in range(12))
# Names that the operators add, and helpers use, as columns of the input.
CLASHES = ("size", "taken", "ids", "n_tokens", "kept", "n_words", "license", "shard", "slot",
           "n_lines", "n_dropped", "node", "key", "component", "row", "target", "repeats", "sig")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, LONG, None, None, 9),
            (4, PROSE, "en", "a", 1), (4, PROSE, "en", "a", 1), (None, PROSE, "en", "b", 1),
            (6, "one two", "en", "b", 7), (7, "\x1c \t\n", "en", "b", 4),
            (8, PROSE + " Once more.", "en", "b", 1), (9, "All rights reserved.", None, "b", 2)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.withColumns({name: F.lit("mine") for name in CLASHES})


@pytest.fixture(scope="module")
def model():
    return html_text.fit_labeller([f"<p>{PROSE}</p>"] * 4, layouts=10)


def ranks():
    return read_ranks(tokenizers().path("byte_bpe_50k.tiktoken"))


def operators(spark, model):
    pattern = tokenizers().PATTERN
    scores = token_counts.zipf_scores(ranks())
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return {
        "line_dedup": lambda d: line_dedup.dedup_lines(d),
        "token_counts": lambda d: token_counts.count_tokens(d, scores, pattern),
        "ngram_join": lambda d: ngram_join.similar_documents(d),
        "sharding": lambda d: sharding.shard_documents(d, F.array(F.xxhash64("text")), size),
        "html": lambda d: html_text.extract_main_text(d, "text", "main", model),
        "mixing": lambda d: mixing.mix(d, F.size(words(F.col("text")))),
        "bpe": lambda d: bpe.encode(d, ranks(), pattern),
        "quality": lambda d: quality.quality_rules(d),
    }


NAMES = ("line_dedup", "token_counts", "ngram_join", "sharding", "html", "mixing", "bpe",
         "quality")


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_one_result(spark, odd, clashing, model, name):
    operator = operators(spark, model)[name]
    assert operator(odd).count() == odd.count()
    got = operator(clashing)
    assert got.count() == odd.count() and len(set(got.columns)) == len(got.columns)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, odd, model, name):
    assert operators(spark, model)[name](odd.limit(0)).collect() == []


def test_license_rows_and_empty(odd, clashing):
    for docs in (odd, clashing):
        assert [(r.doc_id, r.license) for r in license_scan.scan_licenses(docs).collect()] == [
            (9, "All-rights-reserved")]
    assert license_scan.scan_licenses(odd.limit(0)).collect() == []


def test_null_and_empty_texts(spark, odd, model):
    made = operators(spark, model)
    by = {name: {r.doc_id: r for r in made[name](odd).collect()} for name in NAMES}
    for doc in (1, 2):
        assert by["token_counts"][doc].n_tokens == 0 and by["bpe"][doc].ids == []
        assert by["ngram_join"][doc].n_shingles == 0
        assert by["ngram_join"][doc].component_id == doc
        assert by["html"][doc].main == "" and not by["quality"][doc].kept
        assert by["mixing"][doc].taken == 0 and by["sharding"][doc].size == 1
    assert by["line_dedup"][1].text is None and by["line_dedup"][2].text == ""
    assert by["line_dedup"][3].text == LONG
    assert by["ngram_join"][3].n_shingles == 40_000 - 3
    assert by["ngram_join"][7].n_shingles == 1  # U+001C is no white space of the contract
    assert by["ngram_join"][8].component_id == 4 and by["ngram_join"][None].component_id == 4


def test_vectors(spark):
    a, near = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [(5, a), (3, a), (4, near), (1, None), (2, []), (6, [0.0, 0.0, 0.0]),
            (7, [float("nan"), 1.0, 0.0]), (8, [1.0, None, 0.0]), (9, [1e300, 0.0, 0.0]),
            (10, [1.0, 0.0]), (None, a), (11, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in embedding_dedup.near_vectors(df).collect()}
    assert got[5] == (4, 3, False) and got[3] == (4, 3, True) and got[None][:2] == (4, 3)
    assert got[4] == (4, 3, False) and got[9] == (4, 3, False)
    for lone in (1, 2, 6, 7, 8, 10, 11):
        assert got[lone] == (0, lone, True)
    assert embedding_dedup.near_vectors(df.limit(0)).collect() == []


def test_pipeline_stages(spark, odd, clashing):
    for docs in (odd, clashing, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == list(corpus_pipeline.COLUMNS)
        for row in docs.collect():
            assert row.n_tokens == len(row.ids)


def test_pipeline_keeps_one_of_each_group(spark, odd):
    quality_stage, line_stage, near_stage = (stage for _, stage in corpus_pipeline.STAGES[:3])
    good = quality_stage(spark, odd, "")
    assert {r.doc_id for r in good.collect()} == {3, 4, 8, None}
    left = near_stage(spark, line_stage(spark, good, ""), "").collect()
    assert sorted((r.doc_id for r in left), key=str) == [3, 4, None]


def test_long_words_merge_alike():
    table, draw = ranks(), random.Random(3)
    for _ in range(300):
        word = bytes(draw.choice(b"abe  tho") for _ in range(draw.randint(1, 60)))
        assert bpe.merge_short(word, table) == bpe.merge_long(word, table)
    assert b"".join(bpe.merge_long(b"ab" * 50_000, table)) == b"ab" * 50_000


def test_decoding_gives_the_text_back(spark, odd):
    table = ranks()
    coded = bpe.encode(odd.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)), table,
                       tokenizers().PATTERN)
    got = coded.select("sha", F.sha2(bpe.decode(F.col("ids"), table, spark), 256).alias("back"))
    assert all(r.sha == r.back for r in got.collect())
    assert hashlib.sha256(b"").hexdigest() in {r.back for r in got.collect()}


@pytest.mark.parametrize("cycle,seed", [((1, 4), 8), ((3, 2), 1)])
def test_mixing_with_one_document_of_half_a_source(spark, cycle, seed):
    draw = random.Random(4)
    rows = [(k, s, draw.randint(1, 200)) for k, s in enumerate("ab" * 200)]
    small = {s: sum(r[2] for r in rows if r[1] == s) for s in "ab"}
    rows += [(1000, "a", small["a"]), (1001, "b", small["b"])]
    rows += [(7, "b", 5), (7, "b", 3)]  # one id, drawn together
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = mixing.mix(docs, F.col("words"), cycle=cycle, seed=seed).cache()
    for r in got.groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= 0.001 * r.target
    assert got.where("doc_id = 7").select("repeats").distinct().count() == 1
    assert got.where("repeats > 3").count() == 0


@pytest.mark.parametrize("html,want", [
    ('<p>one</p><svg class="i"/><p>two</p><math/><p>three</p>', ["one", "two", "three"]),
    ("<p>one <svg><path d='M0'/><style/><g></svg> two</p>three", ["one two", "three"]),
    ("<p>one</p><object data=x><p>two</p>three", ["one", "two", "three"]),
    ("<p>one</p><svg><g><p>two</p>three</svg>", ["one", "two", "three"]),
    ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p>", ["if x=1 then"]),
    ("<p>one <noscript><img src=x></noscript>two <noscript>three</noscript> four</p>five",
     ["one two", "three", "four", "five"]),
    ("<p><svg><title>one</title><text>two</text></svg>three</p>", ["one two three"]),
    ("<template><p>one</p></template><iframe src=x>two</iframe>", ["one", "two"]),
    ("<svg><text>one</text><foreignObject><div>two</div></foreignObject></svg><p>three",
     ["one", "two", "three"]),
    ("a<script>x('<p>')</script >b<STYLE>p{}</style>c<script>no end<p>d", ["abc"]),
])
def test_blocks_lose_no_text_but_scripts_and_styles(html, want):
    assert [text for _, text, _ in html_blocks.page_blocks(html)] == want


@pytest.mark.parametrize("percent", [50, 60, 70, 75])
def test_sets_of_distant_sizes_share_a_signature(percent):
    draw, scheme = np.random.default_rng(percent), shingles.PartEnum(percent)
    for size in [2, 4, 14, 20, 61, 81, *range(1, 300)]:
        one = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        more = draw.integers(0, 2**63, size * (100 - percent) // percent, dtype=np.uint64)
        x, y = scheme.signatures([one, np.unique(np.concatenate([one, more]))])
        assert len(np.intersect1d(x, y)), size


def test_registered_percentages_sign_two_bands_at_most():
    for percent in (80, 85):
        scheme = shingles.PartEnum(percent)
        for size in range(1, 3_000):
            own = scheme.band_of(size)
            assert scheme.bands_for(size) == (
                [own, own + 1] if size >= scheme.reaching(own + 1) else [own])


def test_pipeline_near_copies_under_one_id(spark):
    near_stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    other = " ".join(f"other{i} text{i} here{i}" for i in range(40))
    third = " ".join(f"third{i} text{i} there{i}" for i in range(40))
    data = [(1, PROSE), (5, PROSE + " Once more."), (5, other), (5, other), (6, other + " x"),
            (None, third), (None, third + " y"), (None, third), (8, ""), (8, ""), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in data], SCHEMA)
    left = collections.Counter(
        (r.doc_id, (r.text.split() or [""])[0]) for r in near_stage(spark, docs, "").collect())
    assert left == {(1, "Plain0"): 1, (5, "other0"): 1, (None, "third0"): 1, (8, ""): 2,
                    (None, ""): 1}
