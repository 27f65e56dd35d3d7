"""Markup that a browser repairs: no words outside tags, scripts, styles and comments are lost."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from shredloom.llm import html_blocks, html_text


def texts(html):
    return [text for _, text, _ in html_blocks.page_blocks(html)]


@pytest.mark.parametrize("html,want", [
    ("<p title=it's>one</p><p>two don't</p><p>three</p>", ["one", "two don't", "three"]),
    ('<p "x>one</p><p>two "quoted"</p>three', ["one", 'two "quoted"', "three"]),
    ("<p a=\"b\"c='d'>one</p>", ["one"]),
    ("<p a='x>y' b=\">\">one</p>", ["one"]),
    ("<p a = 'x>y'>one</p>", ["one"]),
    ("<p a=>one</p>two", ["one", "two"]),
    ("<p a='never closed>one</p><p>two</p>", ["one", "two"]),
    ("<p =x>one</p>", ["one"]),
    ("<p>a</p><!--><p>b</p>", ["a", "b"]),
    ("<p>a</p><!---><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- x --!><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- x > y --><p>b</p><!-- no end <p>c</p>", ["a", "b"]),
    ("<p>a</p><!----><p>b</p>", ["a", "b"]),
    ("<a href=x/y'z>one</a> two", ["one two"]),
])
def test_tags_and_comments_end_where_a_browser_ends_them(html, want):
    assert texts(html) == want


def test_no_word_between_tags_is_lost():
    draw = random.Random(2)
    values = ["x", "it's", '"a b"', "'c>d'", "a\"b", "x/"]
    for _ in range(3_000):
        html, words = "", []
        for n in range(draw.randint(1, 8)):
            tag = draw.choice(["p", "div", "b", "li", "td", "section", "br", "span"])
            attributes = "".join(
                f" {draw.choice(['id', 'class', 'data-x', 'q\"'])}={draw.choice(values)}"
                for _ in range(draw.randint(0, 2)))
            word = f"w{n}{draw.choice(['', chr(39), chr(34)])}"
            words.append(word)
            html += draw.choice(["", "<!-->", "<!-- it's -->", "<!---->"])
            html += f"<{tag}{attributes}>{word} " + (f"</{tag}>" if draw.random() < 0.7 else "")
        assert re.findall(r"\S+", " ".join(texts(html))) == words, html


def test_pieces_of_a_long_page_are_labelled_alike(monkeypatch):
    model = html_text.fit_labeller(["<p>Some words of a page.</p><p>And more of them.</p>"] * 3,
                                   layouts=6)
    draw = random.Random(4)
    html = "".join(draw.choice(["<p>A few words, here.</p>", "<nav><a href=x>menu</a></nav>",
                                "<div class=ad>buy</div>", "<li>one</li>"]) for _ in range(700))
    whole = html_text.Reader(model).texts([html, html[:200]])
    monkeypatch.setattr(html_text, "CELLS", 64)
    assert html_text.Reader(model).texts([html, html[:200]]) == whole


def test_a_dense_page_takes_bounded_memory():
    weights = html_text.Labeller().weights
    reader = html_text.Reader(html_text.Labeller(weights=weights))
    tracemalloc.start()
    reader.texts(["<p>a</p>" * 100_000])  # 0.8 MB of markup
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    assert np.isfinite(weights["V"]).all()
