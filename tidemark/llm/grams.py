"""Hashes of words and of character n-grams, many texts at a time, with numpy.

Texts are laid side by side as code points, each after one separator, so that one pass of
array operations hashes every n-gram of a block. Long texts are cut into pieces at white
space; whatever is summed or united over n-grams is the same for the pieces as for the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 18  # code points that are worked on at once
WHITE = (9, 10, 11, 12, 13, 32)  # what separates words
GAP = re.compile("[\t-\r ]")

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def cuts(text: str, limit: int = BLOCK) -> list[str]:
    """The text in pieces of about ``limit`` code points, cut before white space only."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    while at < len(text):
        gap = GAP.search(text, at + limit)
        end = gap.start() if gap else len(text)
        out.append(text[at:end])
        at = end
    return out


def blocks(texts: Sequence[str | None], limit: int = BLOCK) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of pieces with the row each belongs to; a null text is an empty one."""
    rows, pieces, size = [], [], 0
    for row, text in enumerate(texts):
        for piece in cuts(text if isinstance(text, str) else "", limit):
            if pieces and size + len(piece) > limit:
                yield rows, pieces
                rows, pieces, size = [], [], 0
            rows.append(row)
            pieces.append(piece)
            size += len(piece) + 1
    if pieces:
        yield rows, pieces


class Block:
    """Pieces side by side: ``codes`` holds each after one blank, and one blank at the end.

    ``starts[k]`` is the place of the blank before piece ``k``.
    """

    def __init__(self, pieces: Sequence[str]):
        joined = " " + " ".join(pieces) + " "
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        self.codes = np.where(self.blank, np.uint32(32), codes)
        sizes = np.fromiter((len(p) + 1 for p in pieces), np.int64, len(pieces))
        self.starts = np.cumsum(sizes) - sizes
        self.count = len(pieces)

    def sums(self, values: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """Sums of ``values`` by piece; one value for each code point, or for each of ``places``."""
        bounds = self.starts if places is None else np.searchsorted(places, self.starts)
        total = np.zeros(len(values) + 1, np.float64)
        np.cumsum(values, out=total[1:])
        ends = np.append(bounds[1:], len(values))
        return total[ends] - total[bounds]

    def inside_words(self, n: int) -> np.ndarray:
        """Whether the ``n`` code points from each place on lie in a word and its two borders."""
        size = len(self.codes) - n + 1
        if size <= 0:
            return np.zeros(0, bool)
        ok = ~self.blank[:size] if n == 1 else ~(self.blank[:size] & self.blank[1 : size + 1])
        for k in range(1, n - 1):
            ok &= ~self.blank[k : size + k]
        return ok

    def ngrams(self, most: int) -> Iterator[tuple[int, np.ndarray]]:
        """For n = 1 to ``most``: n and the hash of the n-gram at each place."""
        codes = self.codes.astype(np.uint64) + np.uint64(1)
        rolled = np.zeros(len(codes), np.uint64)
        for n in range(1, most + 1):
            size = len(codes) - n + 1
            if size <= 0:
                return
            rolled = rolled[:size] * _MULTIPLIER + codes[n - 1 :]
            yield n, mix(rolled + np.uint64(n))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """The places at which words begin, and their hashes."""
        inner = ~self.blank
        first = np.flatnonzero(inner[1:] & self.blank[:-1]) + 1
        after = np.flatnonzero(self.blank[1:] & inner[:-1]) + 1
        powers = np.full(len(self.codes), _MULTIPLIER, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        summed = np.zeros(len(powers) + 1, np.uint64)
        np.cumsum(mix(self.codes.astype(np.uint64) + np.uint64(1)) * powers, out=summed[1:])
        back = np.full(len(self.codes), _INVERSE, np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        return first, mix((summed[after] - summed[first]) * back[first] + (after - first).astype(np.uint64))


def word_hashes(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The hash of every word of every text, in order."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, pieces in blocks(texts):
        block = Block(pieces)
        first, hashes = block.words()
        bounds = np.append(np.searchsorted(first, block.starts), len(first))
        for k, row in enumerate(rows):
            out[row].append(hashes[bounds[k] : bounds[k + 1]])
    return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in out]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of fewer words, one of the whole sequence."""
    if not len(words):
        return np.zeros(0, np.uint64)
    k = min(k, len(words)) if len(words) < k else k
    size = len(words) - k + 1
    rolled = np.zeros(size, np.uint64)
    for j in range(k):
        rolled = rolled * _MULTIPLIER + words[j : j + size]
    return np.unique(mix(rolled + np.uint64(k)))
