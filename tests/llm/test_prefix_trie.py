"""The prefix trie against a plain one, also where chunks and segments are tiny."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from shredloom.llm import prefix_trie
from shredloom.llm.common import table
from shredloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def rebuilt(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    first = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, own in first.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = first.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, convs_of in members.items():
        worth = (len(convs_of) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += node not in children
    return sorted((
        min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), children[node],
        leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, ms in members.items())


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op11_prefix_trie"](spark, SF)) == plain_trie(rebuilt(rows))


@pytest.mark.parametrize("width,chunk,seed", [(3, 7, 1), (2, 1, 2), (32, 5, 3), (4, 1000, 4)])
def test_small_chunks_and_segments(spark, width, chunk, seed):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(300), 90):
        for t in range(draw.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, draw.choice(["user", "bot"]) if t > 2 else "user",
                         f"t{draw.randrange(2 if t < 5 else 1)} w" * (t % 3)))
    for c in (400, 401, 402, 460):  # equal ones, to their ends
        rows += [(c, t, "user", f"same {t}") for t in range(20)]
    turns, turnless = prefix_trie.with_shared_heads(prefix_trie.numbered_turns(
        spark.createDataFrame(rows, SCHEMA)), 20, 4)
    got = rows_of(prefix_trie.prefix_trie(turns, turnless, width, chunk))
    assert got == plain_trie(rebuilt(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "gone"), (1, None, None, None), (1, 5, "user", ""), (1, 5, "user", ""),
            (2, 1, "a", "b c"), (2, None, "", None), (60, 0, "x", "one two"), (75, 0, "x", "y"),
            (79, 0, "x", "y"), (3, 2, "ab", "c"), (4, 2, "a", "bc")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' a", "'mine' n", "1 seg")

    def nodes(d):
        return rows_of(prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(
            prefix_trie.numbered_turns(d), 20, 4)))

    assert nodes(df) == plain_trie(rebuilt(rows))
    assert nodes(df.limit(0)) == []
