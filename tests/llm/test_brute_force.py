"""Operators that SQL cannot express, against plain Python on the smallest tables."""

import collections
import math
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from shredloom.llm import html_blocks, html_text, license_scan, shingles, token_counts
from shredloom.llm.common import table
from shredloom.llm.components import connected_components
from shredloom.llm.queries import QUERIES, tokenizers
from shredloom.llm.vocabulary import read_ranks, splitter

SF = "/root/testdata/sf0.001"


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def texts(spark, sf=SF):
    return {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}


def test_connected_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    links += [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    got = dict(map(tuple, connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()))
    want = components({n for link in links for n in link}, links)
    assert all(got.get(n, n) == c for n, c in want.items())


def test_embedding_dedup(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [r.vec_id for r in rows]
    want = components(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))])
    got = {r.vec_id: r for r in QUERIES["op2_embedding_dedup"](spark, SF).collect()}
    for k, vec in enumerate(ids):
        assert (got[vec].n_links, got[vec].component_id) == (near[k].sum(), want[vec])


def test_subspaces_lose_no_pair(spark):
    from shredloom.llm.embedding_dedup import near_vectors
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((60, 24))
    x = np.repeat(centres, 8, axis=0) + 0.22 * draw.standard_normal((480, 24))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)],
                               "vec_id long, embedding array<double>")
    for tile in (16, 100):  # many cells and cuts, and few
        got = {r.vec_id: r.n_links for r in near_vectors(df, tile=tile).collect()}
        assert [got[k] for k in range(480)] == near.sum(axis=1).tolist()


def test_token_counts(spark):
    ranks = read_ranks(tokenizers().path("byte_bpe_50k.tiktoken"))
    start, cut = token_counts.zipf_scores(ranks), splitter(tokenizers().PATTERN)

    def best_pieces(word, scores):
        best = [(0.0, 0, ())]
        for end in range(1, len(word) + 1):
            score, less, s = max((best[s][0] + scores[word[s:end]], -best[s][1], -s)
                                 for s in range(end) if word[s:end] in scores)
            best.append((score, 1 - less, (*best[-s][2], word[-s:end])))
        return best[-1][2]

    parts = {doc: cut.findall(text) for doc, text in texts(spark).items()}
    words = collections.Counter(part for row in parts.values() for part in row)
    used = collections.Counter()
    for word, n in words.items():
        for piece in best_pieces(word.encode(), start):
            used[piece] += n
    docs = table(spark, SF, "documents")
    for limit in (token_counts.MAX_WORDS, 50):  # pieces passed on once and many times
        assert used == {bytes(r.piece): r.n for r in token_counts.piece_counts(
            docs, start, tokenizers().PATTERN, max_words=limit).collect()}
    total = math.log(sum(used.values()) + len(start))
    for scores, found in (
            (start, token_counts.count_tokens(docs, start, tokenizers().PATTERN)),
            ({p: math.log(used[p] + 1) - total for p in start}, QUERIES["op3_token_counts"](spark, SF))):
        lengths = {word: len(best_pieces(word.encode(), scores)) for word in words}
        got = {r.doc_id: r for r in found.collect()}
        for doc, row in parts.items():
            assert (got[doc].n_pretokens, got[doc].n_tokens) == (
                len(row), sum(lengths[part] for part in row))


def test_a_certain_piece_ends_no_search():
    trie = token_counts.PrefixTrie({b"a": 0.0, b"ab": -1.0, b"b": -5.0})
    assert list(trie.segments(b"aab")) == [b"ab", b"a"] and trie.insert(b"aaaa") == 4


def test_estimation_of_nothing_is_even(spark):
    scores = {b"a": -1.0, b"b": -2.0, b"ab": -3.0}
    empty = spark.createDataFrame([(None,), ("",)], "text string")
    for docs in (empty, empty.limit(0)):
        got = token_counts.estimated_scores(docs, scores, r"\w+", steps=2)
        assert set(got) == set(scores) and len(set(got.values())) == 1


def test_small_trie_scores_alike():
    ranks = read_ranks(tokenizers().path("byte_bpe_50k.tiktoken"))
    scores = token_counts.zipf_scores(ranks)
    tiny, wide = token_counts.PrefixTrie(scores, 5), token_counts.PrefixTrie(scores)
    for word in (b" thing", b" things", b"thing", b" thorough", b" thin"):
        assert tiny.insert(word) == wide.insert(word)
    assert len(tiny.best) == 5


def shingle_sets(spark, length=4):
    return {doc: frozenset(shingles.shingle_set(text, length).tolist())
            for doc, text in texts(spark).items()}


def test_ngram_join(spark):
    sets = {}
    for doc, text in texts(spark).items():
        w = text.encode().lower().split()
        sets[doc] = {tuple(w[k:k + 4]) for k in range(max(len(w) - 3, 1))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) > 0]
    want = components(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in QUERIES["op4_ngram_join"](spark, SF).collect()}
    assert got == {doc: (len(sets[doc]), want[doc]) for doc in sets}


@pytest.mark.parametrize("percent,size", [(85, 8), (85, 60), (85, 400), (80, 33), (95, 150)])
def test_similar_sets_share_a_signature(percent, size):
    draw = np.random.default_rng(size)
    scheme = shingles.PartEnum(percent)
    for _ in range(150):
        base = draw.integers(0, 2**63, size, dtype=np.uint64)
        other = base.copy()
        # As different as similar sets can be, by replacement, by addition, and in between.
        n = size * (100 - percent) // (100 + percent) if draw.random() < 0.5 else 0
        other[:n] = draw.integers(0, 2**63, n, dtype=np.uint64)
        more = int(draw.integers(0, size // 5 + 1))
        other = np.concatenate([other, draw.integers(0, 2**63, more, dtype=np.uint64)])
        a, b = np.unique(base), np.unique(other)
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            x, y = scheme.signatures([a, b])
            assert len(np.intersect1d(x, y))


def test_sharding(spark):
    got = QUERIES["op5_sharding"](spark, SF).collect()
    text = texts(spark)
    shards = collections.defaultdict(list)
    together = collections.defaultdict(set)
    for row in got:
        shards[row.shard].append(row.slot)
        together[text[row.doc_id]].add(row.shard)
    sizes = [len(slots) for slots in shards.values()]
    assert len(shards) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    assert all(len(places) == 1 for places in together.values())


def test_sharding_splits_a_group_larger_than_a_shard(spark):
    from shredloom.llm.sharding import shard_documents
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") < 70, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = shard_documents(docs, F.array(F.xxhash64("text")), F.lit(1)).collect()
    assert collections.Counter(r.shard for r in got) == {s: 25 for s in range(8)}


def test_license_inside_other_text(spark):
    head = license_scan.TEMPLATES["MIT"][1]
    noise = " ".join(f"noise{k} word{k}" for k in range(300))
    docs = spark.createDataFrame(
        [(k, noise[:k * 40] + " " + head + " " + noise) for k in range(100)],
        "doc_id long, text string")
    got = license_scan.scan_licenses(docs).collect()
    assert {r.doc_id for r in got if r.license == "MIT"} == set(range(100))
    assert all(r.containment > 0.9 for r in got)


def test_main_text_on_held_out_layouts(spark):
    pages = [r.html for r in table(spark, SF, "pages").orderBy("page_id").collect()]
    reader = html_text.Reader(html_text.fit_labeller(pages[:25]))
    draw, good, total = random.Random(5), 0, 0
    for page in pages[25:]:
        layout = html_text.Layout([b[1] for b in html_blocks.page_blocks(page)], draw)
        for _ in range(4):
            blocks, labels = layout.page()
            if blocks:
                good += (reader.label([blocks])[0] == labels).sum()
                total += len(labels)
    assert good / total > 0.97


def test_main_text_of_the_pages(spark):
    from html import unescape
    import re
    got = {r.page_id: r.text for r in QUERIES["op7_html_text"](spark, SF).collect()}
    for row in table(spark, SF, "pages").collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]+>", "", p)).split())
                 for p in re.split("</?(?:p|h1)>|<br>", article)]
        assert got[row.page_id] == "\n".join(p for p in parts if p)


def test_blocks_of_odd_markup():
    html = ("<body><p>a&nbsp;b<p>c<script>var x='</p>';</script> d<!-- no --> <b>e</b>"
            "<ul><li>f<li>g</ul><img alt='x>y'>h < i<div class=\"ad big\">j</div>")
    assert [(text, path.split("/")[-1]) for path, text, _ in html_blocks.page_blocks(html)] == [
        ("a b", "p"), ("c d e", "p"), ("f", "li"), ("g", "li"), ("h < i", "body"),
        ("j", "div .ad .big")]
    assert html_blocks.page_blocks(None) == [] == html_blocks.page_blocks("<p> </p>")


def test_mixing_comes_near_its_targets(spark):
    sf = "/root/testdata/sf0.01"  # fifty documents of a source
    rows = QUERIES["op8_mixing"](spark, sf).collect()
    source = {r.doc_id: r.source for r in table(spark, sf, "documents").collect()}
    sizes = {d: len(t.encode().split()) for d, t in texts(spark, sf).items()}
    total = collections.Counter()
    for d, n in sizes.items():
        total[source[d]] += n
    names = sorted(total)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    clamped = set()
    while True:
        budget = sum(total.values()) - sum(3 * total[s] for s in clamped)
        free = sum(weight[s] for s in names if s not in clamped)
        target = {s: 3 * total[s] if s in clamped else budget * weight[s] / free for s in names}
        over = {s for s in names if target[s] > 3 * total[s]}
        if not over:
            break
        clamped |= over
    taken = collections.Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r.size == sizes[r.doc_id] and r.source_size == total[s]
        assert r.target == pytest.approx(target[s]) and r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.03 * target[s] for s in names)


def test_encoding_is_that_of_the_public_library(spark):
    import hashlib
    tokens = tokenizers()
    coder = tiktoken.Encoding("own", pat_str=tokens.PATTERN, special_tokens={},
                              mergeable_ranks=read_ranks(tokens.path("byte_bpe_50k.tiktoken")))
    got = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, SF).collect()}
    for doc, text in texts(spark).items():
        ids = coder.encode_ordinary(text)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
