"""Texts cut into pre-tokens as a tokenizer library cuts them, and a table of the distinct ones met so far."""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import regex

MOST_PIECES = 400_000  # distinct pieces a table remembers before it begins anew


class Splitter:
    """Matches of a pattern over ``\\p{L}``, ``\\p{N}`` and ``\\s``, by the character classes of the library.

    ``regex`` and the libraries follow different versions of Unicode. They agree on all characters that
    Python's own tables know; ``class_of`` tells the library's class ('L', 'N', 's' or '') of any other one, and a
    stand-in of that class takes its place while the text is cut.
    """

    STAND_IN = {"L": "x", "N": "1", "s": " ", "": "!"}

    def __init__(self, pattern: str, class_of: Callable[[str], str]):
        self.pattern = regex.compile(pattern)
        self.class_of = class_of
        self.plain = {chr(c) for c in range(128)}  # characters met so far that need no stand-in
        self.odd: dict[int, str] = {}

    def _stands_alone(self, text: str) -> bool:
        """Whether no character needs a stand-in; notes the class of new ones."""
        new = set(text) - self.plain
        fine = {c for c in new if unicodedata.category(c) != "Cn"}
        self.plain |= fine
        self.odd |= {ord(c): self.STAND_IN[self.class_of(c)] for c in new - fine if ord(c) not in self.odd}
        return fine == new

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.plain.issuperset(text) or self._stands_alone(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.odd))]


class Pieces(dict):
    """Numbers of distinct pieces, and the ids of each in one flat array; ``encode`` gives those of new ones."""

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], most: int = MOST_PIECES):
        super().__init__()
        self.encode, self.most = encode, most
        self.flat = array("i")
        self.ends = array("q", [0])

    def numbers(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in dict.fromkeys(pieces) if p not in self]
        for piece, ids in zip(new, self.encode(new), strict=True):
            self[piece] = len(self)
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        return np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))

    def fresh(self) -> Pieces:
        """Itself, or an empty table when it holds its bound."""
        full = len(self) >= self.most or len(self.flat) >= 8 * self.most
        return Pieces(self.encode, self.most) if full else self

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by their numbers, one after another, and how many each has."""
        flat, ends = np.array(self.flat, np.int32), np.array(self.ends, np.int64)
        start, count = ends[numbers], ends[numbers + 1] - ends[numbers]
        return flat[spread(start, count)], count


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), start[1], ..."""
    total = int(count.sum())
    shift = start - (np.cumsum(count) - count)
    return np.repeat(shift, count) + np.arange(total)
