"""Token ids of texts by a vocabulary file of the tokenizers library, one call per distinct word.

The library cleans a text, cuts it at white space and merges each part on its own, so the ids of
a text are those of its words. Words are looked up; only new ones go to the library, plain ones
many at a time. Latin letters are lowered here and need only the library's merges: cleaning and
cutting them took it as long again.
"""

from __future__ import annotations

import re
import string
import unicodedata
from itertools import compress, islice
from operator import add, not_

import numpy as np

KEPT_WORDS = 600_000   # words whose ids a task remembers: memory only, results do not depend on it
BLOCK = 1 << 20        # bytes of a text whose words are listed at once
JOINED = 100           # plain words given to the library as one text
STOPS = string.punctuation.replace("'", "")  # stand for themselves behind letters; 's does not
# Letters that are composed, and have one lower case in every version of Unicode.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
ID = np.dtype("<u4")


class WordTokenizer:
    """`json` is the content of a vocabulary file with word ends and no other context."""

    def __init__(self, json: str, kept: int = KEPT_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(json)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merges = Tokenizer(self.library.model)  # the same vocabulary, for clean words
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = [name.endswith("</w>") for name, _ in sorted(
            self.library.get_vocab(with_added_tokens=False).items(), key=lambda item: item[1])]
        self.ends_word = np.array(ends)
        self.kept = kept
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; none for null."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for place, text in enumerate(texts):
            for block in blocks((text or "").encode()):
                held.append((place, block.split()))
                size += len(block)
                if size >= BLOCK:
                    self._look_up(held, found)
                    held, size = [], 0
        self._look_up(held, found)
        return [np.frombuffer(b"".join(parts), ID) for parts in found]

    def _look_up(self, held: list[tuple[int, list[bytes]]], found: list[list[bytes]]) -> None:
        if len(self.known) > self.kept:
            self.known = dict(islice(self.known.items(), self.kept // 2))  # the first are frequent
        new = set().union(*(words for _, words in held)).difference(self.known)
        if new:
            self._learn(list(new))
        for place, words in held:
            found[place].append(b"".join(map(self.known.__getitem__, words)))

    def _learn(self, words: list[bytes]) -> None:
        texts = b" ".join(words).decode().split(" ")
        stems = [text.rstrip(STOPS) for text in texts]
        latin = [LATIN(stem) is not None for stem in stems]
        plain = [is_latin or one_part(stem) for is_latin, stem in zip(latin, stems)]
        whole = list(map(not_, plain))
        tails = list(compress(map(str.removeprefix, texts, stems), plain))
        stems = [stem.lower() if is_latin else stem for is_latin, stem in zip(latin, stems)]
        found = self._encode_plain(list(set(compress(stems, latin))), self.merges)
        found |= self._encode_plain(
            list(set(compress(stems, plain)).difference(found)), self.library)
        texts = list(compress(texts, whole))
        singles = list({*texts, *tails})
        other = dict(zip(singles, map(packed, self._encode(singles))))
        self.known.update(zip(compress(words, plain), map(
            add, map(found.__getitem__, compress(stems, plain)), map(other.__getitem__, tails))))
        self.known.update(zip(compress(words, whole), map(other.__getitem__, texts)))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_plain(self, stems: list[str], tokenizer) -> dict[str, bytes]:
        """Words that are one part each, many joined: the last token of a part tells its end."""
        groups = [stems[k:k + JOINED] for k in range(0, len(stems), JOINED)]
        found: dict[str, bytes] = {}
        for group, coded in zip(groups, tokenizer.encode_batch_fast(
                [" ".join(group) for group in groups], add_special_tokens=False)):
            ids = np.array(coded.ids, ID)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):  # some word is more than one part after all
                found.update(zip(group, map(packed, self._encode(group))))
                continue
            data, cuts = ids.tobytes(), [0, *(ends * ID.itemsize).tolist()]
            found.update(zip(group, map(data.__getitem__, map(slice, cuts, cuts[1:]))))
        return found


def one_part(word: str) -> bool:
    """Letters only, also once composed and in lower case."""
    return word.isalpha() and (
        word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def packed(ids: list[int]) -> bytes:
    return np.array(ids, ID).tobytes()


def blocks(data: bytes):
    """The text in blocks that end at white space."""
    start = 0
    while len(data) - start > BLOCK:
        ends = [at for at in (data.find(space, start + BLOCK, start + 2 * BLOCK)
                              for space in (b" ", b"\n")) if at >= 0]
        if not ends:
            break
        yield data[start:min(ends)]
        start = min(ends)
    yield data[start:]
