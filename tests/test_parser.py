import random
import tracemalloc
from xml.parsers import expat

import pytest

from shredloom.operators import xml_rows
from shredloom.operators.xml_rows import parse_document


def elements(text, **options):
    out = []
    for paths, kids, texts, attrs in parse_document(text.encode(), **options):
        pairs = dict(attrs)
        out += [(path, kid, value, pairs.get(at, []))
                for at, (path, kid, value) in enumerate(zip(paths, kids, texts))]
    return out


def texts(text):
    return {path: value for path, _, value, _ in elements(text)}


def test_index_only_among_siblings_of_one_name():
    paths = [path for path, *_ in elements("<r><a/><b/><a><c/></a></r>")]
    assert paths == ["/r", "/r/a[1]", "/r/b", "/r/a[2]", "/r/a[2]/c"]


def test_document_order_and_child_counts():
    assert [(path, kids) for path, kids, *_ in elements("<r><a><b/></a><c/></r>")] == [
        ("/r", 2), ("/r/a", 1), ("/r/a/b", 0), ("/r/c", 0)]


def test_parent_text_holds_all_descendants():
    assert texts("<r><a>1<b>2</b>3</a><c>4</c></r>") == {
        "/r": "1234", "/r/a": "123", "/r/a/b": "2", "/r/c": "4"}


def test_parent_text_can_be_left_out():
    assert [(path, value) for path, _, value, _ in
            elements("<r><a>1</a></r>", parent_text=False)] == [("/r", None), ("/r/a", "1")]


def test_blank_text_between_elements_goes():
    compact = "<r><a>1</a><b><c>2</c></b></r>"
    indented = "<r>\n  <a>1</a>\n  <b>\n    <c>2</c>\n  </b>\n</r>"
    assert elements(compact) == elements(indented)


@pytest.mark.parametrize("xml, value", [
    ("<r> </r>", " "),                             # the whole content of a leaf
    ("<r>a <b/> </r>", "a  "),                     # after text came first
    ("<r> <b/>x</r>", "x"),
    ("<r><b/>x <c/></r>", "x "),
    ("<r> <!-- note --> </r>", ""),
    ("<r>x<!-- note --> </r>", "x "),
    ("<r><![CDATA[ ]]></r>", " "),
    ("<r> &amp; </r>", " & "),
    ("<r><![CDATA[a<b]]>&lt;c</r>", "a<b<c"),
    ("<r/>", ""),
])
def test_text_rules(xml, value):
    assert texts(xml)["/r"] == value


def test_long_text_arrives_whole():
    body = " " * 20_000 + "x" + "y " * 20_000
    assert texts(f"<r>{body}</r>")["/r"] == body


def test_attributes_keep_their_order_and_prefixes_stay_on_paths():
    (path, _, _, pairs), _ = elements('<irs:r b="2" a="1" xmlns:irs="u"><c/></irs:r>')
    assert path == "/irs:r" and pairs == ["b", "2", "a", "1", "xmlns:irs", "u"]


@pytest.mark.parametrize("xml", [
    '<!DOCTYPE r [<!ENTITY e "boom">]><r>&e;</r>',
    '<!DOCTYPE r [<!ENTITY a "x"><!ENTITY b "&a;&a;">]><r>&b;</r>',
])
def test_entity_declarations_are_refused(xml):
    with pytest.raises(ValueError):
        elements(xml)


@pytest.mark.parametrize("xml", ["", "<r>", "<r></s>", "<r>&nope;</r>", "plain"])
def test_broken_documents_raise(xml):
    with pytest.raises(expat.ExpatError):
        elements(xml)


def streamed(text, **options):
    root, slices = xml_rows.stream_document(text.encode(), **options)
    out = {}
    for orders, paths, kids, texts, attrs in slices:
        pairs = dict(attrs)
        for at, (order, *rest) in enumerate(zip(orders, paths, kids, texts)):
            assert order not in out
            out[order] = (*rest, pairs.get(at, []))
    assert root == out[1][3]
    return [out[order] for order in sorted(out)]


def random_xml(draw, depth=0):
    """Elements, texts, blanks, comments, instructions and CDATA in any order."""
    inner = [draw.choice(["", " ", "\n  ", "x", " y ", "&amp;", "<!-- n -->", "<?p i?>",
                          "<![CDATA[ ]]>", "<![CDATA[a<b]]>", "é" * 30])
             if depth > 4 or draw.random() < 0.6 else random_xml(draw, depth + 1)
             for _ in range(draw.randint(0, 6))]
    name = draw.choice("ab")
    pairs = draw.choice(["", " k='1'", " p:k='2' xmlns:p='u'"])
    return f"<{name}{pairs}>{''.join(inner)}</{name}>"


@pytest.mark.parametrize("parent_text", [True, False])
@pytest.mark.parametrize("feed", [1, 7, 1 << 20])
def test_two_walks_give_what_one_gives(monkeypatch, feed, parent_text):
    monkeypatch.setattr(xml_rows, "FEED", feed)
    monkeypatch.setattr(xml_rows, "SLICE", 3)
    draw = random.Random(feed)
    for _ in range(300):
        xml = random_xml(draw)
        assert streamed(xml, parent_text=parent_text) == elements(xml, parent_text=parent_text)


@pytest.mark.parametrize("xml", ["", "<r>", "<r></s>", "<r>&nope;</r>", "plain"])
def test_broken_large_documents_raise_before_the_first_row(xml):
    with pytest.raises(expat.ExpatError):
        xml_rows.stream_document(xml.encode())


def test_large_documents_need_bounded_memory():
    """On top of its bytes a document of 12 MB and 1.2 million elements takes few."""
    xml = b"<r>" + b"<g><v k='1'>1</v></g>" * 600_000 + b"</r>"
    tracemalloc.start()
    try:
        count = sum(len(part[0]) for part, _ in xml_rows.numbered_elements(xml, False, None))
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(xml) > xml_rows.LARGE and count == 1_200_001 and held < 60 << 20


def test_slices_cover_a_large_document(monkeypatch):
    monkeypatch.setattr(xml_rows, "SLICE", 7)
    xml = "<r>" + "".join(f"<g><v k='{i}'>{i}</v></g>" for i in range(100)) + "</r>"
    out = elements(xml)
    assert len(out) == 201
    assert out[0][2] == "".join(map(str, range(100)))
    assert out[-1] == ("/r/g[100]/v", 0, "99", ["k", "99"])
