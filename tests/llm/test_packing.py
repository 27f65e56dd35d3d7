"""Packing: every id in one place, windows full, and the library's own ids."""

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from shredloom.llm import packing
from shredloom.llm.common import table
from shredloom.llm.queries import QUERIES, tokenizers
from shredloom.llm.word_tokens import WordTokenizer, blocks

SF = "/root/testdata/sf0.001"
# Characters at which normalising, lower case and cutting differ.
ODD = [*"abAB'sSz.,!?-0129 \n\t\r\x0b\x0c\x1c\x1f<|>_", "é", "é", "İ", "ß", "Σ", "ς", "σ", "ﬁ",
       "½", "中", "文", "ा", "क", "😀", "\x85", " ", " ", "　", "'s", "'re",
       "<|endoftext|>", "</w>"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizers().path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(vocabulary):
    made = Tokenizer.from_str(vocabulary)
    made.encode_special_tokens = True
    return made


def check(rows, wanted):
    """`rows` of (doc, start, length, crc, doc_tokens, sequence, offset) hold each id once."""
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        docs[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    assert set(docs) == set(wanted)
    for doc, pieces in docs.items():
        at, ids = 0, wanted[doc]
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    lengths = []
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        lengths.append(at)
        assert at == pieces[0].window
    assert sorted(sequences) == list(range(len(sequences)))
    return lengths


def test_packing(spark, library):
    wanted = {r.doc_id: np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
              for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op13_packing"](spark, SF).collect()
    lengths = check(rows, wanted)
    # A window is full in its tier; the last few of a task are powers of two as well.
    assert all(n <= 4096 and n & (n - 1) == 0 for n in lengths)
    assert sum(n in packing.TIERS for n in lengths) >= len(lengths) - 9
    steps = collections.defaultdict(lambda: [0, set()])
    for r in rows:
        steps[r.step][0] += r.length
        steps[r.step][1].add(r.window)
    assert all(total <= packing.STEP_TOKENS and len(sizes) == 1 for total, sizes in steps.values())


def test_pool_keeps_every_token():
    draw = random.Random(5)
    for tiers in ((8, 16, 32), (4, 8)):
        pool, seen, n = packing.Pool(tiers), collections.Counter(), 0
        windows = []
        for number in range(400):
            length = draw.choice([1, 2, 3, 7, 8, 15, 16, 31, 32, 33, 100])
            n += length
            windows += pool.add(number, length)
            if draw.random() < 0.05:
                windows += pool.pack()
        windows += pool.pack()
        assert all(size in tiers for size, _ in windows)
        rest = list(pool.rest())
        assert sum(size for size, _ in rest) < tiers[-1]
        for size, pieces in windows + rest:
            assert sum(p[0] for p in pieces) == size
            for length, number, start in pieces:
                seen.update((number, at) for at in range(start, start + length))
        assert len(seen) == n and set(seen.values()) == {1}


def test_ids_are_those_of_the_library(vocabulary, library):
    draw, mine = random.Random(1), WordTokenizer(vocabulary, kept=50)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 40))) for _ in range(8_000)]
    texts += ["It's the end. It's THE END, isn't it?" * 30, "x" * 3_000, ". ... 'tis 'S"]
    for text, ids in zip(texts, mine.encode_all(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_blocks_end_at_white_space():
    data = b"ab cd\n" * 600_000
    parts = list(blocks(data))
    assert len(parts) > 1 and b"".join(parts) == data
    assert all(part[:1].isspace() for part in parts[1:])


def test_odd_documents(spark, vocabulary, library):
    rows = [(1, None), (2, ""), (None, "one two"), (4, "many words " * 9_000), (5, " \x1c \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'mine' ids", "'mine' task", "1 window")
    got = packing.pack_documents(docs, vocabulary).selectExpr("*", "crc32(ids) ids_crc32").collect()
    check(got, {doc: np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
                for doc, text in rows})
    again = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string")
    assert sorted(r.length for r in packing.pack_documents(again, vocabulary).collect()) != []
    assert sum(r.length for r in packing.pack_documents(again, vocabulary).collect()) == 9
    assert packing.pack_documents(docs.limit(0), vocabulary).collect() == []


def test_latin_words_need_only_the_merges(vocabulary, library):
    """Words of Latin letters are right without the library's cleaning, which sees none of them."""
    class Seen:
        def __init__(self, inner):
            self.inner, self.texts = inner, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.inner.encode_batch_fast(texts, **options)

    mine = WordTokenizer(vocabulary)
    mine.library = seen = Seen(mine.library)
    text = "Über ÀÉÎÕÜ straße### (naïve) l'été it's Ångström%%. ÿ ﬁne Σας don't, ½ Öl=\u0338 e\u0301t"
    assert mine.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    asked = " ".join(seen.texts).split()
    assert not {"über", "Über", "straße", "ångström", "Ångström", "ÿ", "Ångström%%."} & set(asked)
    assert {"(naïve", "l'été", "Öl=\u0338"} <= {word.rstrip(")") for word in asked}
