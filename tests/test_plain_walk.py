"""Plain documents walked together give the rows that the parser gives one by one."""

import random

import pyarrow as pa
import pytest

from shredloom.functions.paths import PATH_PREFIXES
from shredloom.operators import xml_rows

NAMES = ["A", "B", "irs:C", "Long-Name.x", "é", "A_1"]
TEXTS = ["", "", "x", "  ", "\n  ", " a b ", "5 > 4", "it's", 'say "no"', "a &amp; b", "&lt;b&gt;&quot;&apos;",
         "&amp;lt;", "žluť", "\t", "]]", "&#65;", "<!-- c -->", "<?p i?>", "<![CDATA[ ]]>", "\r\n"]
ATTRIBUTES = ["", "", "", ' n="1"', ' returnVersion="2001v1.0"', " k='2'", ' xmlns:q="u" q:n = "é"', ' a="" b="x y"',
              ' a="1 > 0"', ' a="&amp;"', ' a="two\nlines"', " ", "\n", ' a="it\'s"', ' a="b=c d"']


def element(random, depth, odd):
    name, texts = random.choice(NAMES), TEXTS if odd else TEXTS[:15]
    attributes = random.choice(ATTRIBUTES if odd else ATTRIBUTES[:5])
    if random.random() < 0.1:
        return f"<{name}{attributes}/>"
    inner = random.choice(texts)
    if depth:
        for _ in range(random.randrange(4)):
            inner += element(random, depth - 1, odd) + random.choice(texts)
    return f"<{name}{attributes}>{inner}</{name}>"


def document(random, odd):
    text = (random.choice(["", "", '<?xml version="1.0" encoding="utf-8"?>\n', "\n", "<?xml version='1.0'?>"])
            + element(random, random.randrange(6), odd) + random.choice(["", "\n"]))
    if odd and random.random() < 0.2:  # most of these are not well-formed
        at = random.randrange(len(text))
        text = text[:at] + random.choice(["", "<", ">", "&", "/", '"', "<x>"]) + text[at + 1:]
    return text


def rows_of(texts, kind, *options):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([f"u{k}" for k in range(len(texts))]), pa.array(range(len(texts))),
         pa.array([t and t.encode() for t in texts], pa.binary()).cast(kind)],
        names=["url", "n", "xml"])
    derived = xml_rows.PathTexts(PATH_PREFIXES)
    made = list(xml_rows.element_batches(options[0], derived, options[1], ("url",))(iter([batch])))
    assert all(part.num_rows <= xml_rows.MAX_ROWS + xml_rows.SLICE for part in made)
    names = [field.name for field in made[0].schema]
    assert all(part.schema == made[0].schema for part in made)
    rows = [row for part in made for row in part.to_pylist()]
    return sorted((tuple(repr(row[name]) for name in names) for row in rows),
                  key=lambda row: (int(row[1]), int(row[2])))


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("kind", [pa.string(), pa.binary()])
def test_same_rows_as_the_parser(monkeypatch, seed, kind):
    chance = random.Random(seed)
    texts = [document(chance, seed % 3 > 0) for _ in range(300)] + [None, "", "﻿<A>1</A>"]
    options = (seed % 2 == 0, seed % 4 < 2)
    monkeypatch.setattr(xml_rows, "plain_start", lambda xml, encoding: None)
    wanted = rows_of(texts, kind, *options)
    monkeypatch.undo()
    monkeypatch.setattr(xml_rows, "FEW_TAGS", 1)
    monkeypatch.setattr(xml_rows, "TOGETHER", chance.choice([200, 5_000, 1 << 19]))
    monkeypatch.setattr(xml_rows, "MAX_ROWS", chance.choice([7, 16_384]))
    assert rows_of(texts, kind, *options) == wanted


def test_plain_documents_are_not_walked_one_by_one(monkeypatch):
    def refused(*_):
        raise AssertionError("plain documents need no calls from the parser")

    monkeypatch.setattr(xml_rows, "listen", refused)
    texts = ["<A><B n=\"1\">x &amp; y</B><B/></A>"] * 1_000
    assert len(rows_of(texts, pa.string(), True, False)) == 3_000


def test_long_texts_are_left_to_the_parser(monkeypatch):
    monkeypatch.setattr(xml_rows, "FEW_TAGS", 1)
    deep = "".join(f"<A{k}>" for k in range(50)) + "x" * 100 + "".join(
        f"</A{k}>" for k in reversed(range(50)))
    wanted = rows_of([deep] * 3, pa.string(), True, False)
    monkeypatch.setattr(xml_rows, "MAX_CHARS", 1_000)
    monkeypatch.setattr(xml_rows._Rows, "plain", None)
    assert rows_of([deep] * 3, pa.string(), True, False) == wanted
