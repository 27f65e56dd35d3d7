"""Blocks of text of an HTML page, with the tags they stand in."""

from __future__ import annotations

import re
from html import unescape

# Element kinds of HTML.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in ("script", "style")}
# What these hold stands in for something else: blocks of its own, inside any paragraph.
APART = frozenset("iframe noscript object template".split())
FOREIGN = frozenset(("svg", "math"))
SPACED = frozenset("text title desc".split())  # foreign elements of words of their own
# Foreign elements that hold HTML; foreign elements are open under a name with a colon.
POINTS = frozenset(f":{tag}" for tag in (
    "foreignobject desc title annotation-xml mi mo mn ms mtext").split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img input button br".split()) | APART
# A start tag of the first kind ends an open element of the second.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
           "body": ("head",), "tbody": ("thead", "tbody"), "tfoot": ("thead", "tbody")}
# Implied ends do not reach beyond these.
SCOPE = frozenset("table ul ol dl td th body html article section div nav aside main".split())
WITHIN = {"li": frozenset("ul ol".split()), "tr": frozenset(["table"]),
          "td": frozenset(["table"]), "th": frozenset(["table"]), "dt": frozenset(["dl"]),
          "dd": frozenset(["dl"])}

# These end foreign content that is still open.
LEAVING = SCOPE | frozenset(IMPLIED) | frozenset(
    "aside b big blockquote br center code dl em embed figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr i img listing menu meta nobr p pre ruby s small span strong strike sub sup tt u "
    "var".split())

# A quote opens a value right behind the equals sign only; elsewhere it is part of a name or value.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+"
    r"(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)?+)?+)*+)>", re.S | re.I)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-zA-Z]+")


def inline(tag: str) -> bool:
    return tag in INLINE or tag[0] == ":"


def attribute_names(attributes: str) -> str:
    """The words of class, id and role, in lower case: `.sidebar .left`."""
    found = []
    for _, a, b, c in NAMES.findall(attributes):
        found += [f".{word.lower()}" for word in PART.findall(a or b or c)]
    return " ".join(dict.fromkeys(found))


class Page:
    """Collects the blocks of one page: (path, text, characters inside links)."""

    def __init__(self):
        self.open: list[tuple[str, str]] = []   # tag and its path entry
        self.blocks: list[tuple[str, str, int]] = []
        self.text: list[str] = []
        self.linked = self.links = 0
        self.path = ""
        self.apart = False  # the next text starts a block

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.path, text, self.linked))
        self.text, self.linked = [], 0

    def enter(self, tag: str, attributes: str) -> None:
        names = attribute_names(attributes) if "=" in attributes else ""
        self.open.append((tag, f"{tag} {names}".rstrip()))

    def trim(self, size: int) -> None:
        self.links -= sum(tag == "a" for tag, _ in self.open[size:])
        del self.open[size:]

    def foreign(self) -> bool:
        return bool(self.open) and self.open[-1][0][0] == ":" and self.open[-1][0] not in POINTS

    def start(self, tag: str, attributes: str) -> None:
        if self.foreign() and tag in LEAVING:
            while self.open and self.open[-1][0][0] == ":":
                self.trim(len(self.open) - 1)
        if tag in FOREIGN or self.foreign():
            if tag in SPACED:
                self.text.append(" ")
            if not attributes.endswith("/"):
                self.enter(f":{tag}", "")
            return
        self.apart |= tag in APART
        if tag == "br":
            self.text.append(" ")
            return
        if tag in INLINE:
            if tag not in VOID:
                self.enter(tag, attributes)
                self.links += tag == "a"
            return
        self.end_block()
        if tag in VOID:
            return
        ends = IMPLIED.get(tag, ())
        stop = WITHIN.get(tag, SCOPE)
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            # Every block ends an open paragraph, and the inline elements left open in it.
            if name == "p" or name in ends:
                self.trim(at)
                break
            if name in stop:
                break
        self.enter(tag, attributes)
        self.note_path()

    def finish(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == f":{tag}":
                if tag in SPACED:
                    self.text.append(" ")
                self.trim(at)
                return
            if self.open[at][0][0] != ":":
                break
        if tag in FOREIGN:
            return
        if tag in APART:
            if not self.apart:
                self.end_block()
            self.apart = False
        if tag not in INLINE:
            self.end_block()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.trim(at)
                break
            if tag in INLINE and not inline(self.open[at][0]):
                break
        if tag not in INLINE:
            while self.open and inline(self.open[-1][0]):
                self.trim(len(self.open) - 1)
            self.note_path()

    def note_path(self) -> None:
        self.path = "/".join(entry for tag, entry in self.open if not inline(tag))

    def write(self, text: str) -> None:
        if self.apart and text.strip():
            self.end_block()
            self.apart = False
        self.text.append(text)
        if self.links:
            self.linked += len(text)


def page_blocks(html: str | None) -> list[tuple[str, str, int]]:
    """(path, text, linked characters) of each block in page order; none for null or empty.

    References are decoded, white space becomes one space, blocks without text are left out.
    Scripts, styles and comments are skipped, nothing else; `/>` ends elements of svg and math.
    Unclosed and misnested elements are repaired as far as the order of blocks needs it.
    """
    page, at = Page(), 0
    html = html or ""
    while token := TOKEN.search(html, at):
        if token.start() > at:
            page.write(unescape(html[at:token.start()]))
        at = token.end()
        tag = (token.group(2) or "").lower()
        attributes = token.group(3) or ""
        if not tag:
            continue
        if token.group(1):
            page.finish(tag)
        elif tag not in RAW:
            page.start(tag, attributes)
        elif not (page.foreign() and attributes.endswith("/")):
            end = RAW[tag].search(html, at)
            at = end.end() if end else len(html)
    page.write(unescape(html[at:]))
    page.end_block()
    return page.blocks
