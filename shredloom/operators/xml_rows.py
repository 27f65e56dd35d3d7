"""Turns XML text into element rows inside a task, one Arrow batch at a time.

The only code that runs in Python workers. It walks a document once with expat, or the tags of
many plain documents at once with numpy, and knows nothing of crosswalks or keys; those are Column
expressions on its output. What follows from a
path alone is derived here once per distinct path of a batch, not once per element.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = " \t\r\n"
# Fields of an element while its document is read.
UP, NAME, NTH, TALLY, START, STOP, PAIRS, TEXT_FIRST, TEXT_LAST, OTHER, PATH = range(11)

# A batch handed back to the JVM is closed at whichever comes first.
MAX_ROWS = 16_384
MAX_CHARS = 32 << 20
# Elements of one document handed on at a time.
SLICE = 4_096
# Documents of more bytes are walked twice, so that their elements are never held together.
LARGE = 8 << 20
FEED = 1 << 18  # bytes given to the parser at a time on the second walk
# Plain documents are walked together, up to so many bytes, and apart if there are few tags.
TOGETHER = 1 << 19
FEW_TAGS = 1_000

# Distinct paths whose derived texts a task remembers: memory only.
KEPT_PATHS = 50_000
INDEX = re.compile(r"\[[0-9]+\]")
UTF_8 = re.compile(rb"""encoding\s*=\s*["']utf-8["']""")
PAIR = re.compile(rb'([^\s=]+) *= *"([^"]*)"')
ENTITIES = ((b"&lt;", b"<"), (b"&gt;", b">"), (b"&quot;", b'"'), (b"&apos;", b"'"), (b"&amp;", b"&"))

VERSION = "returnVersion"  # attribute of the root that every element of its document carries

ATTRS_TYPE = pa.list_(pa.struct([("attr_name", pa.string()), ("attr_value", pa.string())]))


def refuse(*_):
    raise ValueError("entity declarations are not accepted")


def new_parser(encoding: str | None):
    """Entity declarations are refused."""
    parser = expat.ParserCreate(encoding)
    parser.buffer_text = True
    parser.ordered_attributes = True
    parser.EntityDeclHandler = refuse
    parser.SkippedEntityHandler = refuse
    return parser


def listen(parser, opened: Callable[[list], None],
           closed: Callable[[list], None] | None = None) -> list[str]:
    """Calls back with each element as it starts and ends; returns the growing list of texts.

    Blank text between elements is dropped; blank text that is an element's whole content, or
    part of mixed content, stays.
    """
    chunks: list[str] = []
    add_chunk = chunks.append
    top: list = [None, "", 0, None, 0, 0, (), False, False, False, ""]  # the document itself
    blank = ""
    cdata = False

    def keep(text):
        chunks.append(text)
        top[TEXT_LAST] = True
        if top[TALLY] is None and not top[OTHER]:
            top[TEXT_FIRST] = True

    def settle(closing):
        nonlocal blank
        text, blank = blank, ""
        alone = closing and top[TALLY] is None and not top[OTHER]
        if alone or top[TEXT_FIRST] or top[TEXT_LAST]:
            keep(text)

    def on_start(name, pairs):
        nonlocal top
        if blank:
            settle(False)
        tally = top[TALLY]
        if tally is None:
            top[TALLY] = {name: 1}
            count = 1
        else:
            count = tally.get(name, 0) + 1
            tally[name] = count
        top[TEXT_LAST] = False
        top = [top, name, count, None, len(chunks), 0, pairs, False, False, False, ""]
        opened(top)

    def on_end(_name):
        nonlocal top
        if blank:
            settle(True)
        top[STOP] = len(chunks)
        if closed:
            closed(top)
        top = top[UP]

    def on_text(text):
        nonlocal blank
        if blank:
            text, blank = blank + text, ""
        if cdata or text.strip(BLANK):
            add_chunk(text)
            top[TEXT_LAST] = True
            if top[TALLY] is None and not top[OTHER]:
                top[TEXT_FIRST] = True
        else:
            blank = text

    def on_other(*_):
        if blank:
            settle(False)
        top[OTHER], top[TEXT_LAST] = True, False

    def on_cdata():
        nonlocal cdata
        if blank:
            settle(False)
        cdata = True

    def after_cdata():
        nonlocal cdata
        cdata = False

    parser.StartElementHandler = on_start
    parser.EndElementHandler = on_end
    parser.CharacterDataHandler = on_text
    parser.CommentHandler = on_other
    parser.ProcessingInstructionHandler = on_other
    parser.StartCdataSectionHandler = on_cdata
    parser.EndCdataSectionHandler = after_cdata
    return chunks


def parse_document(xml: bytes, parent_text: bool = True, encoding: str | None = "UTF-8",
                   root_text: bool = True) -> Iterator[tuple]:
    """Parses at once, then yields the elements in document order, up to `SLICE` at a time, as
    lists of paths, numbers of child elements, texts, and (position, attribute pairs).

    Sibling indexes are written only among two or more children of one name. With `encoding`
    None the document's byte order mark or declaration says how it is encoded, UTF-8 if there is
    neither. Without `root_text` the root has no text: that is the whole document's.
    """
    elements: list[list] = []
    parser = new_parser(encoding)
    chunks = listen(parser, elements.append)
    parser.Parse(xml, True)

    def slices():
        for low in range(0, len(elements), SLICE):
            paths, kids, texts, attrs = [], [], [], []
            add_path, add_kids, add_text = paths.append, kids.append, texts.append
            for element in elements[low:low + SLICE]:
                parent, name, count, tally, first, last, pairs, _, _, _, _ = element
                if parent[TALLY][name] > 1:
                    path = f"{parent[PATH]}/{name}[{count}]"
                else:
                    path = f"{parent[PATH]}/{name}"
                element[PATH] = path
                if pairs:
                    attrs.append((len(paths), pairs))
                add_path(path)
                if tally is None:
                    add_kids(0)
                    add_text(chunks[first] if last - first == 1 else "".join(chunks[first:last]))
                else:
                    add_kids(sum(tally.values()))
                    add_text("".join(chunks[first:last]) if parent_text else None)
            if not low and not root_text:
                texts[0] = None
            yield paths, kids, texts, attrs

    return slices()


def plain_start(xml: bytes, encoding: str | None) -> int | None:
    """Where to look for the root of a plain document, None if it is not plain or not well-formed.

    Plain documents are UTF-8 and have nothing but elements, attributes, texts and the five
    predefined entities. What they hold is checked by the parser, without calls into Python.
    """
    at = 0
    if len(xml) > TOGETHER:
        return None
    if xml.startswith(b"<?xml"):
        at = xml.find(b"?>") + 2
        head = xml[:at].lower()
        if encoding is None and b"encoding" in head and not UTF_8.search(head):
            return None
    if (xml.find(b"<!", at) >= 0 or xml.find(b"<?", at) >= 0 or b"\r" in xml or b"&#" in xml
            or b"\0" in xml):
        return None
    try:
        expat.ParserCreate(encoding).Parse(xml, True)
    except (expat.ExpatError, ValueError, LookupError):
        return None
    return at


class _Tags:
    """The tags of plain documents laid end to end.

    `odd` are the documents with a tag whose end or attributes need the parser: quotes that may
    hide a bracket, entities or line breaks in attributes.
    """

    def __init__(self, bodies: list[bytes]) -> None:
        self.text = b"".join(bodies)
        self.data = np.frombuffer(self.text, np.uint8)
        self.low = np.flatnonzero(self.data == ord("<"))
        ends = np.flatnonzero(self.data == ord(">"))
        self.high = ends[np.searchsorted(ends, self.low)]
        starts = np.cumsum([0] + [len(body) for body in bodies[:-1]])
        self.doc = np.searchsorted(starts, self.low, "right") - 1
        quotes = self.inside('"')
        wrong = np.bincount(quotes, minlength=len(self.low)) % 2 == 1
        for char in "'&\n\t":
            wrong[self.inside(char)] = True
        self.odd = set(self.doc[wrong].tolist())

    def inside(self, char: str) -> np.ndarray:
        """The tag of each such character in tags."""
        places = np.flatnonzero(self.data == ord(char))
        tags = np.searchsorted(self.low, places, "right") - 1
        known = tags >= 0
        places, tags = places[known], tags[known]
        return tags[places < self.high[tags]]


def _kept_texts(tags: _Tags, level: np.ndarray, opens: np.ndarray, ends: np.ndarray,
                shut: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The texts that are kept, laid end to end, and where they have got to before each tag.

    `level` counts the open elements behind each tag. As in `listen`: blank text stays if it is
    an element's whole content, or if the element's content begins with other text.
    """
    data, text = tags.data, tags.text
    first, last = tags.high[:-1] + 1, tags.low[1:]
    sizes = np.where(tags.doc[:-1] == tags.doc[1:], last - first, 0)
    runs = np.flatnonzero(sizes)
    white = np.zeros(256, bool)
    white[[ord(char) for char in BLANK]] = True
    blank = white[data[first[runs]]]
    if blank.any():
        dark = np.concatenate(([0], np.cumsum(~white[data])))
        blank = dark[first[runs]] == dark[last[runs]]
    keep = ~blank
    if blank.any():
        begun = np.zeros(len(tags.low), bool)  # start tags with other text behind them
        begun[runs[keep]] = True
        begun &= opens & ~shut
        for run in np.flatnonzero(blank & opens[runs] & ~shut[runs]).tolist():
            keep[run] = ends[runs[run] + 1]
        later = np.flatnonzero(blank & (ends[runs] | shut[runs]) & (level[runs] > 0))
        starts = np.flatnonzero(opens & ~shut)
        for depth in np.unique(level[runs[later]]).tolist() if begun.any() else ():
            here = later[level[runs[later]] == depth]
            at = starts[level[starts] == depth]
            owner = at[np.searchsorted(at, runs[here]) - 1]
            keep[here] = begun[owner]
    runs = runs[keep]
    pieces = [text[a:b] for a, b in zip(first[runs].tolist(), last[runs].tolist())]
    sizes = np.zeros(len(tags.low), np.int64)
    sizes[runs] = [len(piece) for piece in pieces]
    marks = np.flatnonzero(data == ord("&"))
    for run in np.unique(np.searchsorted(first[runs], marks, "right") - 1).tolist() if len(
            marks) else ():
        for entity, char in ENTITIES:
            pieces[run] = pieces[run].replace(entity, char)
        sizes[runs[run]] = len(pieces[run])
    return b"".join(pieces), np.cumsum(sizes) - sizes


def plain_elements(tags: _Tags, parent_text: bool = True, root_text: bool = True) -> tuple | None:
    """All elements of plain documents, those of `parse_document`, in document order: document,
    number, index of the path, distinct paths, children, texts, (element, attribute pairs).

    None if the texts are too long to be held together.
    """
    low, high, data, text = tags.low, tags.high, tags.data, tags.text
    ends = data[low + 1] == ord("/")
    opens = ~ends
    shut = opens & (data[high - 1] == ord("/"))
    level = np.cumsum(np.where(ends, -1, np.where(shut, 0, 1)))
    held, upto = _kept_texts(tags, level, opens, ends, shut)

    starts = np.flatnonzero(opens)
    depth = level[starts] - ~shut[starts]
    count = len(starts)
    closes = starts.copy()  # the tag that ends each element
    above = np.full(count, -1)
    by_depth, end_depth = [], level[ends]
    end_tags = np.flatnonzero(ends)
    for d in range(int(depth.max()) + 1):
        here = np.flatnonzero(depth == d)
        whole = here[~shut[starts[here]]]
        closes[whole] = end_tags[end_depth == d]
        if d:
            above[here] = by_depth[-1][np.searchsorted(by_depth[-1], here) - 1]
        by_depth.append(here)
    sizes = upto[closes] - upto[starts]
    if sizes.sum() > MAX_CHARS:
        return None

    spaced = np.zeros(len(low), bool)
    spaced[tags.inside(" ")] = True
    named = [text[a:b] for a, b in zip((low[starts] + 1).tolist(),
                                       (high[starts] - shut[starts]).tolist())]
    attrs = []
    for at in np.flatnonzero(spaced[starts]).tolist():
        named[at], _, rest = named[at].partition(b" ")
        pairs = [part.decode() for pair in PAIR.findall(rest) for part in pair]
        if pairs:
            attrs.append((at, pairs))
    codes: dict[bytes, int] = {}
    name = np.array([codes.setdefault(n, len(codes)) for n in named])
    names = [n.decode() for n in codes]

    # Siblings of one name: how many there are, and which one an element is.
    kin = (above + 1) * len(names) + name
    kin[depth == 0] = -1 - np.arange(len(by_depth[0]))
    order = np.argsort(kin, kind="stable")
    edges = np.flatnonzero(np.diff(kin[order], prepend=kin[order[0]] - 1))
    many = np.diff(edges, append=count)
    nth = np.empty(count, np.int64)
    nth[order] = np.arange(count) - np.repeat(edges, many) + 1
    nth[order[np.repeat(many, many) == 1]] = 0

    paths: list[str] = []
    place = np.empty(count, np.int64)  # of an element's path
    width = int(nth.max()) + 1
    for d, here in enumerate(by_depth):
        up = place[above[here]] if d else np.zeros(len(here), np.int64)
        distinct, inverse = np.unique((up * len(names) + name[here]) * width + nth[here],
                                      return_inverse=True)
        place[here] = len(paths) + inverse
        rest, index = np.divmod(distinct, width)
        parent, own = np.divmod(rest, len(names))
        paths += [f"{paths[p] if d else ''}/{names[n]}[{i}]" if i else
                  f"{paths[p] if d else ''}/{names[n]}"
                  for p, n, i in zip(parent.tolist(), own.tolist(), index.tolist())]
    kids = np.bincount(above[above >= 0], minlength=count)
    texts = [held[a:b] for a, b in zip(upto[starts].tolist(), upto[closes].tolist())]
    if not parent_text:
        for at in np.flatnonzero(kids).tolist():
            texts[at] = None
    docs = tags.doc[starts]
    if not root_text:
        for at in by_depth[0].tolist():
            texts[at] = None
    first = np.repeat(by_depth[0], np.diff(by_depth[0], append=count))
    return docs, np.arange(count) - first + 1, place, paths, kids, texts, attrs


def survey_document(xml: bytes, encoding: str | None = "UTF-8") -> tuple:
    """First walk of a large document: per element in document order, the number of its child
    elements and whether a sibling has its name; and the attribute pairs of the root.

    Five bytes an element are kept, and the names of open elements' children.
    """
    kids, repeated, root = array("i"), bytearray(), []
    open_elements: list[tuple[int, dict]] = []  # position, first child of each name

    def on_start(name, pairs):
        at = len(kids)
        kids.append(0)
        repeated.append(0)
        if open_elements:
            parent, firsts = open_elements[-1]
            kids[parent] += 1
            first = firsts.setdefault(name, at)
            if first != at:
                repeated[first] = repeated[at] = 1
        else:
            root.extend(pairs)
        open_elements.append((at, {}))

    parser = new_parser(encoding)
    parser.StartElementHandler = on_start
    parser.EndElementHandler = lambda _name: open_elements.pop()
    parser.Parse(xml, True)
    return kids, repeated, root


def stream_document(xml: bytes, parent_text: bool = True, encoding: str | None = "UTF-8",
                    root_text: bool = True) -> tuple[list, Iterator[tuple]]:
    """The root's attribute pairs, and the elements of `parse_document` as they end, with their
    numbers in document order in front.

    The document is walked twice. Held are the survey, one slice, and of the texts only those of
    open elements: of a leaf, or with `parent_text` all that the root's own text consists of.
    """
    kids_of, repeated, root = survey_document(xml, encoding)
    numbers: list[int] = []  # of the open elements
    seen = 0
    orders, paths, kids, texts, attrs, chars = [], [], [], [], [], 0

    def opened(element):
        nonlocal seen
        seen += 1
        numbers.append(seen)
        above, name, count = element[UP][PATH], element[NAME], element[NTH]
        element[PATH] = (f"{above}/{name}[{count}]" if repeated[seen - 1] else f"{above}/{name}")
        if not parent_text:
            chunks.clear()
            element[START] = 0

    def closed(element):
        nonlocal chars
        order = numbers.pop()
        if order == 1 and not root_text or element[TALLY] is not None and not parent_text:
            text = None
        else:
            text = "".join(chunks[element[START]:element[STOP]])
            chars += len(text)
        if not parent_text:
            chunks.clear()
        if element[PAIRS]:
            attrs.append((len(paths), element[PAIRS]))
        orders.append(order)
        paths.append(element[PATH])
        kids.append(kids_of[order - 1])
        texts.append(text)

    parser = new_parser(encoding)
    chunks = listen(parser, opened, closed)

    def slices():
        nonlocal orders, paths, kids, texts, attrs, chars
        view = memoryview(xml)
        for at in range(0, len(xml), FEED):
            parser.Parse(view[at:at + FEED], False)
            if len(paths) >= SLICE or chars >= FEED:
                ready = orders, paths, kids, texts, attrs
                orders, paths, kids, texts, attrs, chars = [], [], [], [], [], 0
                yield ready
        parser.Parse(b"", True)
        if paths:
            yield orders, paths, kids, texts, attrs

    return root, slices()


class PathTexts:
    """What `functions.paths` derives from a path, for the paths that the walk writes.

    `derive_paths` says the same of any paths, as Column expressions.
    """

    def __init__(self, prefixes: tuple[str, ...], legacy: bool = False) -> None:
        self.prefixes, self.legacy = prefixes, legacy
        self.known: dict[str, tuple[str, str, str, str]] = {}

    def texts(self, path: str) -> tuple[str, str, str, str]:
        """XPATH2, TABLE_ID, and TABLE_HEADER of a parent and of a terminal element."""
        if path in self.known:
            return self.known[path]
        if self.legacy:
            bare = path.replace(self.prefixes[-1], "")
        else:
            bare = INDEX.sub("", path)
            for prefix in self.prefixes:
                bare = bare.replace(prefix, "")
        at = path.rfind("[")
        number = path[at + 1:path.index("]", at)] if at >= 0 else "0"
        second = bare.find("/", 1)
        own = bare[second:] if second > 0 else ""
        above = bare[:max(0, len(bare) - len(bare.rpartition("/")[2]) - 1)]
        made = (bare, f"TID-{number:0>5}", *(
            "//" + "/".join(context.split("/")[-2:]).lstrip("/") for context in (own, above)))
        if len(self.known) >= KEPT_PATHS:
            self.known.clear()
        self.known[path] = made
        return made

    def columns(self, paths: pa.Array, kids: pa.Array) -> list[pa.Array]:
        """XPATH2, TABLE_ID and TABLE_HEADER of each row; a row without path has no table."""
        coded = paths if pa.types.is_dictionary(paths.type) else paths.dictionary_encode()
        distinct = [self.texts(path) for path in coded.dictionary.to_pylist()]
        bare, number, own, above = (
            pa.array([texts[k] for texts in distinct], pa.string()).take(coded.indices)
            for k in range(4))
        header = pc.if_else(pc.fill_null(pc.greater(kids, 0), False), own, above)
        return [bare, pc.fill_null(number, "TID-00000"), header]


class _Rows:
    """Rows waiting to become one Arrow batch."""

    def __init__(self) -> None:
        self.count = self.chars = 0
        self.runs: list[tuple[int, int]] = []  # document, rows
        self.versions: list[str | None] = []  # of each run
        self.orders = array("i")
        self.path, self.kids, self.text = [], [], []
        self.attr_row, self.attr_name, self.attr_value = [], [], []
        self.reasons: dict[int, str] = {}

    def full(self) -> bool:
        return self.count >= MAX_ROWS or self.chars >= MAX_CHARS

    def add_pairs(self, row, pairs) -> None:
        for name, value in zip(pairs[::2], pairs[1::2]):
            if name != "xmlns" and not name.startswith("xmlns:"):
                self.attr_row.append(row)
                self.attr_name.append(name.rpartition(":")[2])
                self.attr_value.append(value)

    def add(self, doc, orders, paths, kids, texts, attrs, version=None) -> None:
        for at, pairs in attrs:
            self.add_pairs(self.count + at, pairs)
        self.runs.append((doc, len(paths)))
        self.versions.append(version)
        self.orders.extend(orders)
        self.path += paths
        self.kids += kids
        self.text += texts
        self.count += len(paths)
        self.chars += sum(map(len, filter(None, texts)))

    def fail(self, doc, reason) -> None:
        self.reasons[self.count] = reason
        self.add(doc, (0,), [None], [None], [None], ())

    def batch(self, carried: pa.RecordBatch, derived: PathTexts | None,
              once: tuple[str, ...] = ()) -> pa.RecordBatch:
        docs, counts = np.array(self.runs, np.int32).T
        errors = (pa.array(map(self.reasons.get, range(self.count)), pa.string())
                  if self.reasons else pa.nulls(self.count, pa.string()))
        return self.assembled(
            carried, derived, once, np.repeat(docs, counts),
            np.frombuffer(self.orders, np.int32), pa.array(self.path, pa.string()),
            pa.array(self.kids, pa.int32()), pa.array(self.text, pa.string()), errors,
            pa.array(self.versions, pa.string()).take(
                pa.array(np.repeat(np.arange(len(counts)), counts))))

    def plain(self, found: tuple, rows: np.ndarray, carried: pa.RecordBatch,
              derived: PathTexts | None, once: tuple[str, ...]) -> pa.RecordBatch:
        """One batch of what `plain_elements` found; `rows` are its documents' rows."""
        docs, orders, place, paths, kids, texts, attrs = found
        self.count = len(docs)
        versions: list[str | None] = [None] * len(rows)
        for at, pairs in attrs:
            self.add_pairs(at, pairs)
            if orders[at] == 1:
                versions[docs[at]] = attribute_of(pairs, VERSION)
        return self.assembled(
            carried, derived, once, rows[docs].astype(np.int32), orders.astype(np.int32),
            pa.DictionaryArray.from_arrays(pa.array(place, pa.int32()), pa.array(paths, pa.string())),
            pa.array(kids, pa.int32()), pa.array(texts, pa.binary()).cast(pa.string()),
            pa.nulls(self.count, pa.string()),
            pa.array(versions, pa.string()).take(pa.array(docs, pa.int32())))

    def assembled(self, carried, derived, once, rows, orders, paths, kids, texts, errors,
                  versions) -> pa.RecordBatch:
        per_row = np.bincount(self.attr_row, minlength=self.count)
        offsets = np.concatenate(([0], np.cumsum(per_row)))
        pairs = pa.StructArray.from_arrays(
            [pa.array(self.attr_name, pa.string()), pa.array(self.attr_value, pa.string())],
            fields=list(ATTRS_TYPE.value_type))
        first, rows = pa.array(rows, pa.int32(), mask=orders > 1), pa.array(rows, pa.int32())
        columns = [column.take(first if name in once else rows)
                   for name, column in zip(carried.schema.names, carried.columns)] + [
            pa.array(orders),
            paths.cast(pa.string()),
            kids,
            texts,
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
            errors,
            versions,
        ]
        names = carried.schema.names + [
            "ORDER", "XPATH", "N_CHILDREN", "VALUE", "ATTRS", "ERROR", "VERSION"]
        if derived:
            columns += derived.columns(paths, kids)
            names += ["XPATH2", "TABLE_ID", "TABLE_HEADER"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def attribute_of(pairs, wanted: str) -> str | None:
    """An attribute out of an element's pairs, whatever its prefix."""
    for name, value in zip(pairs[::2], pairs[1::2]):
        if name.rpartition(":")[2] == wanted and not name.startswith("xmlns:"):
            return value
    return None


def numbered_elements(xml: bytes, parent_text: bool, encoding: str | None,
                      root_text: bool = True) -> Iterator[tuple[tuple, str | None]]:
    """Slices of a document's elements with their numbers, each with the root's version."""
    if len(xml) > LARGE:
        root, slices = stream_document(xml, parent_text, encoding, root_text)
        version = attribute_of(root, VERSION)
        return ((part, version) for part in slices)
    slices = parse_document(xml, parent_text, encoding, root_text)

    def numbered():
        order, version = 1, None
        for part in slices:
            attrs = part[3]
            if order == 1 and attrs and attrs[0][0] == 0:
                version = attribute_of(attrs[0][1], VERSION)
            count = len(part[0])
            yield (range(order, order + count), *part), version
            order += count

    return numbered()


def element_batches(parent_text: bool = True, derived: PathTexts | None = None,
                    root_text: bool = True, once: tuple[str, ...] = ()):
    """A function for `mapInArrow`: batches with an `xml` column -> batches of elements.

    With `derived` XPATH2, TABLE_ID and TABLE_HEADER follow the other columns.

    Every other column is carried along, those named in `once` on a document's first row only;
    without `root_text` its root has no text. A document that cannot be parsed gives one row with
    ORDER 0 and the reason in ERROR. Binary documents are decoded as they declare; text has been
    decoded before, whatever it declares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = batch.column("xml")
            encoding = None if pa.types.is_binary(documents.type) else "UTF-8"
            documents = documents.cast(pa.binary())
            carried = batch.select([n for n in batch.schema.names if n != "xml"])
            rows = _Rows()
            waiting: list[tuple[int, bytes, int]] = []  # plain documents, where they start
            size = 0
            for doc in range(batch.num_rows + 1):
                apart = []
                if doc < batch.num_rows:
                    xml = documents[doc].as_py() or b""
                    start = plain_start(xml, encoding)
                    if start is None:
                        apart = [(doc, xml)]
                    else:
                        waiting.append((doc, xml, start))
                        size += len(xml)
                if size >= TOGETHER or doc == batch.num_rows:
                    made, apart_too = together(waiting, carried)
                    yield from made
                    apart += apart_too
                    waiting, size = [], 0
                for number, xml in apart:
                    try:
                        elements = numbered_elements(xml, parent_text, encoding, root_text)
                    except (expat.ExpatError, ValueError, LookupError) as problem:
                        rows.fail(number, str(problem))
                        continue
                    for part, version in elements:
                        rows.add(number, *part, version)
                        if rows.full():
                            yield rows.batch(carried, derived, once)
                            rows = _Rows()
            if rows.count:
                yield rows.batch(carried, derived, once)

    def together(waiting, carried) -> tuple[list[pa.RecordBatch], list[tuple[int, bytes]]]:
        """Batches of plain documents walked at once, and the documents left to the parser."""
        if sum(xml.count(b"<") for _, xml, _ in waiting) < FEW_TAGS:
            return [], [(doc, xml) for doc, xml, _ in waiting]
        tags = _Tags([xml[start:] for _, xml, start in waiting])
        apart = [waiting[k][:2] for k in sorted(tags.odd)]
        if apart:
            rest = [entry for k, entry in enumerate(waiting) if k not in tags.odd]
            made, more = together(rest, carried)
            return made, apart + more
        found = plain_elements(tags, parent_text, root_text)
        if found is None:
            return [], [(doc, xml) for doc, xml, _ in waiting]
        whole = _Rows().plain(found, np.array([doc for doc, _, _ in waiting]), carried, derived,
                              once)
        return [whole.slice(at, MAX_ROWS) for at in range(0, whole.num_rows, MAX_ROWS)], apart

    return run
