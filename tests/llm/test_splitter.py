"""Pre-tokens by sets of characters are those of the pattern's properties."""

import random

import pytest
import regex

from shredloom.llm import vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")


def by_properties(pattern):
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


def test_every_character_up_to_ffff_is_split_as_by_its_properties():
    wanted = by_properties(public_tokenizers.PATTERN)
    split = vocabulary.splitter(public_tokenizers.PATTERN)
    assert isinstance(split, vocabulary.Splitter)
    points = [chr(k) for k in range(0x10000) if not 0xD800 <= k < 0xE000]
    for k in range(0, len(points), 512):
        text = "".join(f"a{c} {c}{c}1{c}\n" for c in points[k:k + 512])
        assert split.narrow(text) == wanted.findall(text) == split.findall(text)


def test_random_texts_with_and_without_characters_beyond_ffff():
    wanted = by_properties(public_tokenizers.PATTERN)
    split, dice = vocabulary.splitter(public_tokenizers.PATTERN), random.Random(3)
    letters = "ab1²½ \t\n\x1c\x1f\x85\xa0\u2028\u3000\ufeff'srtve.,-_éßаб日本一\u0301"
    plain = "".join(map(chr, range(128)))
    for choice in (letters, letters + "😀𝒜𝟘𠀀", plain, "ab1 \t\n'stre.\x1c\x0b"):
        for _ in range(1_000):
            text = "".join(dice.choices(choice, k=dice.randrange(40)))
            assert split.findall(text) == wanted.findall(text)


@pytest.mark.parametrize("pattern", [r"\w+|\s", r"\p{Lu}+", r"[\S]+", r"\d+"])
def test_other_patterns_are_left_to_their_engine(pattern):
    assert vocabulary.narrow_pattern(pattern, 0x80) is None
    assert not isinstance(vocabulary.splitter(pattern), vocabulary.Splitter)
