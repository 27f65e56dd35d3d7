"""Vocabulary files of public tokenizers: read on the driver, of fixed size."""

from __future__ import annotations

import base64
import functools
import re

# Escapes of a pattern that stand for sets of characters, and the properties they name.
PROPERTIES = {r"\p{L}": "L", r"\p{N}": "N", r"\s": "White_Space", r"\S": "White_Space"}


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte pieces and their ranks from a file of `base64 rank` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def splitter(pattern: str):
    """The compiled pattern, its white space read as the Unicode property of that name.

    Python counts the control characters U+001C to U+001F as white space; the property, which
    the encoder's own engine uses, does not.
    """
    import regex

    whole = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                          .replace(r"\S", r"\P{White_Space}"))
    if narrow_pattern(pattern, 0) is None:
        return whole
    return Splitter(whole, narrow_pattern(pattern, 0x10000), narrow_pattern(pattern, 0x80))


class Splitter:
    """Finds what the pattern finds, by sets of characters wherever a text has none beyond U+FFFF,
    by small sets where it has ASCII only."""

    def __init__(self, whole, narrow: str, plain: str):
        self.whole, self.narrow = whole.findall, re.compile(narrow).findall
        self.plain = re.compile(plain).findall
        self.beyond = re.compile("[\U00010000-\U0010FFFF]").search

    def findall(self, text: str) -> list[str]:
        if text.isascii():
            return self.plain(text)
        return self.whole(text) if self.beyond(text) else self.narrow(text)


def narrow_pattern(pattern: str, limit: int) -> str | None:
    """The pattern for Python's own, faster engine, with the characters below `limit` of its
    properties written out; None for one with other escapes than these."""
    made, rest, inside = [], pattern, False
    while rest:
        name = next((n for n in PROPERTIES if rest.startswith(n)), None)
        if name is None and rest[0] == "\\" or name == r"\S" and inside:
            return None
        if name:
            ranges = characters(PROPERTIES[name], limit)
            made.append(ranges if inside else f"[{'^' if name == r'\S' else ''}{ranges}]")
        else:
            inside = rest[0] == "[" or inside and rest[0] != "]"
            made.append(rest[0])
        rest = rest[len(name or rest[0]):]
    return "".join(made)


@functools.cache
def characters(name: str, limit: int) -> str:
    """The characters below `limit` with a property, as ranges of a set."""
    import regex

    found = regex.finditer(rf"\p{{{name}}}+", "".join(map(chr, range(limit))))
    return "".join(rf"\u{m.start():04x}-\u{m.end() - 1:04x}" for m in found)
