"""Word shingles as 64-bit hashes, and PartEnum signatures of their sets, in numpy."""

from __future__ import annotations

import math

import numpy as np
import xxhash

# Odd multipliers.
WORD_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                         0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                         0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SEED_MASKS = np.array([0x0, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xC3A5C85C97CB3127], np.uint64)
SEEDS = len(SEED_MASKS)  # partitions tried before empty parts count


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, length: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle as a whole.

    bytes.lower() changes A-Z alone, bytes.split() cuts at the six ASCII white space characters.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(length, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        total += hashes[k:len(words) - span + 1 + k] * WORD_FACTORS[k]
    return np.unique(mixed(total))


def set_key(features: np.ndarray) -> bytes:
    """128 bits that identify a set."""
    return xxhash.xxh3_128_digest(features.tobytes())


def profile(features: np.ndarray) -> np.ndarray:
    """How many features of a set fall into each equal range of their values, 255 at most.

    There are two to four features to a range, as long as there are no more than 32,768 ranges.
    """
    bits = min(max(len(features).bit_length() - 2, 6), 15)
    counts = np.bincount((features >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def most_common(one: np.ndarray, two: np.ndarray) -> int | None:
    """A bound that the common features of two sets never exceed; None if a range is full."""
    if max(one.max(), two.max()) == 255:
        return None
    ranges = min(len(one), len(two))
    one, two = (x.reshape(ranges, -1).sum(axis=1, dtype=np.int64) for x in (one, two))
    return int(np.minimum(one, two).sum())


class PartEnum:
    """Signatures of which two sets with Jaccard similarity of percent/100 share at least one.

    Sizes are cut into bands. Sets of one band, and those of the bands below that are not too
    small for it, differ in at most k features if they are similar. Features are dealt into
    k + r + spare parts, so that at least r + spare parts agree in full, and each part that is
    not empty gives a signature. A pair can share empty parts only where both are empty: while
    one of the two sets has no more than `spare` empty parts, r parts with features agree.
    Sets with more empty parts are dealt again by another seed, and after the last seed their
    empty parts give signatures too. r is 2, so that one chance agreement is not enough, but 1
    in the bands below `two_from`, whose few parts would become too small.
    """

    TWO_PARTS = 4  # smallest k with r = 2

    def __init__(self, percent: int, growth: float = 1.3):
        if not 0 < percent <= 100:
            raise ValueError(f"percent is {percent}, must be above 0 and at most 100")
        self.percent, self.growth = percent, growth
        self.bands: list[tuple[int, int]] = []
        self.shapes: dict[int, tuple[int, int]] = {}

    def band(self, number: int) -> tuple[int, int]:
        """Smallest and largest size."""
        while len(self.bands) <= number:
            low = self.bands[-1][1] + 1 if self.bands else 1
            self.bands.append((low, max(low, int(low * self.growth))))
        return self.bands[number]

    def band_of(self, size: int) -> int:
        number = 0
        while self.band(number)[1] < size:
            number += 1
        return number

    def parts(self, number: int) -> tuple[int, int]:
        """(parts, spare) of the partition that serves a band."""
        if number not in self.shapes:
            self.shapes[number] = self.shape(number)
        return self.shapes[number]

    def shape(self, number: int) -> tuple[int, int]:
        largest = self.band(number)[1]
        k = 2 * largest * (100 - self.percent) // (100 + self.percent)
        smallest = self.reaching(number)
        empty = (k + 1) * math.exp(-smallest / (k + 1))
        spare = int(empty + 2 * math.sqrt(empty)) if k >= 8 else 0
        return k + (2 if k >= self.TWO_PARTS else 1) + spare, spare

    @property
    def two_from(self) -> int:
        """Smallest size whose sets share two signatures with every similar one of its bands."""
        number = 0
        while 2 * self.band(number)[1] * (100 - self.percent) // (100 + self.percent) < (
                self.TWO_PARTS):
            number += 1
        return self.band(number)[0]

    def reaching(self, number: int) -> int:
        """Smallest size whose sets can be similar to one of the band."""
        return -(-self.band(number)[0] * self.percent // 100)

    def bands_for(self, size: int) -> list[int]:
        numbers = [self.band_of(size)]
        while size >= self.reaching(numbers[-1] + 1):
            numbers.append(numbers[-1] + 1)
        return numbers

    def signatures(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        """Signatures of each set, none for an empty one."""
        found: list[list[np.ndarray]] = [[] for _ in sets]
        work = [(i, band) for i, s in enumerate(sets) if len(s) for band in self.bands_for(len(s))]
        for seed in range(SEEDS):
            work = self._deal(sets, work, seed, found) if work else []
        return [np.concatenate(f) if f else np.empty(0, np.uint64) for f in found]

    def _deal(self, sets, work, seed, found) -> list[tuple[int, int]]:
        """Adds signatures by one seed; returns what has too many empty parts for it."""
        owners = np.array([i for i, _ in work])
        bands = np.array([band for _, band in work], np.uint64)
        shapes = np.array([self.parts(band) for _, band in work])
        n_parts, spare = shapes[:, 0], shapes[:, 1]
        ends = np.cumsum(n_parts)
        starts = ends - n_parts
        sizes = np.array([len(sets[i]) for i in owners])
        features = mixed(np.concatenate([sets[i] for i in owners]) ^ SEED_MASKS[seed])
        slot = ((features >> np.uint64(32)) * np.repeat(n_parts.astype(np.uint64), sizes)
                >> np.uint64(32)).astype(np.int64) + np.repeat(starts, sizes)
        sums = np.zeros(ends[-1], np.uint64)
        np.add.at(sums, slot, mixed(features ^ WORD_FACTORS[5]))
        full = np.zeros(ends[-1], bool)
        full[slot] = True
        part = np.arange(ends[-1]) - np.repeat(starts, n_parts)
        labels = (part.astype(np.uint64) * WORD_FACTORS[6]
                  + np.repeat(bands, n_parts) * WORD_FACTORS[7] + np.uint64(seed))
        values = mixed(sums ^ mixed(labels))
        empty = n_parts - np.add.reduceat(full, starts, dtype=np.int64)
        again = []
        for place, (i, band) in enumerate(work):
            at = slice(starts[place], ends[place])
            poor = empty[place] > spare[place]
            if poor and seed < SEEDS - 1:
                again.append((i, band))
            found[i].append(values[at] if poor and seed == SEEDS - 1 else values[at][full[at]])
        return again


def similar(common, a, b, percent: int):
    """Whether sets of sizes a and b with so many common features are similar enough."""
    return (100 * common >= percent * (a + b - common)) & (common > 0)


def links_within(sets: list[np.ndarray], others: list[np.ndarray] | None, percent: int,
                 columns: int = 2_048) -> np.ndarray:
    """Boolean matrix of the similar pairs of sets and others (of sets alone: i < j)."""
    right = sets if others is None else others
    everything = np.concatenate([*sets, *(others or [])])
    names, place, counts = np.unique(everything, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # features of one set alone are in no intersection
    owner = np.repeat(np.arange(len(sets) + len(others or [])),
                      [len(s) for s in [*sets, *(others or [])]])
    used = counts[place] > 1
    column, owner = number[place][used], owner[used]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(sets), len(right)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        low, high = np.searchsorted(column, [start, start + columns])
        present = np.zeros((len(sets) + len(others or []), columns), np.float32)
        present[owner[low:high], column[low:high] - start] = 1
        common += present[:len(sets)] @ (present if others is None else present[len(sets):]).T
    a, b = np.array([len(s) for s in sets]), np.array([len(s) for s in right])
    near = similar(common.astype(np.int64), a[:, None], b[None, :], percent)
    return np.triu(near, 1) if others is None else near
