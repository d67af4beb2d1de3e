"""Cuts texts where every byte-level BPE splitter of the usual pattern cuts them too, so that parts can be remembered.

The pattern's tokens hold a blank only as their first character or within a run of white space whose last blank goes
to the word behind it. A cut before a blank that stands before a non-blank character is therefore always a border
between two matches, and no match looks beyond it.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from quotemill.shipping import ship_by_value

_ODD = re.compile(r" (?!\S)")  # a blank before white space or the end: no cut there
_CUT = re.compile(r" (?=\S)")
SIGNS = string.punctuation
REMEMBERED = 250_000  # keys of a generation, some 50 MB


def cut(text: str) -> list[str]:
    """Parts without the blank in front of every part but the first: `" ".join(cut(text)) == text`."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def word_and_signs(part: str) -> list[str] | None:
    """The one or two matches of a part that is a word and the ASCII signs behind it; None for other parts.

    Only letters below U+0250 count, about which all versions of Unicode agree.
    """
    word = part.rstrip(SIGNS)
    if not word.isalpha() or not (word.isascii() or max(word) < "\u0250"):
        return None
    return [f" {word}"] if len(word) == len(part) else [f" {word}", part[len(word) :]]


class Generations:
    """Results by key in two dictionaries: when the new one is full it becomes the old one, whose own keys go.

    Keys that are asked for move to the new one, so what is common stays, and the size is bounded.
    """

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}

    def unknown(self, keys: set) -> list:
        """Make room, and say which keys are in neither dictionary; all others are in ``now`` afterwards."""
        if len(self.now) > self.limit:
            self.old, self.now = self.now, {}
        missing = keys.difference(self.now)
        found = [k for k in missing if k in self.old]
        self.now.update((k, self.old[k]) for k in found)
        return list(missing.difference(found))


class PartEncoder:
    """texts -> packed ids. ``split`` cuts a part into units, ``encode_units`` packs units; both are remembered."""

    def __init__(self, split: Callable[[str], list[str]], encode_units: Callable[[list[str]], list[bytes]], limit: int = REMEMBERED):
        self.split, self.encode_units = split, encode_units
        self.parts, self.units = Generations(limit), Generations(limit)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cuts = [cut(text) for text in texts]
        new = self.parts.unknown(set().union(*(words[1:] for words in cuts)))
        split = [word_and_signs(part) or self.split(f" {part}") for part in new]
        fronts = [self.split(words[0]) for words in cuts]
        wanted = self.units.unknown({unit for found in split for unit in found}.union(*fronts))
        units, parts = self.units.now, self.parts.now
        units.update(zip(wanted, self.encode_units(wanted)))
        parts.update(zip(new, [units[f[0]] if len(f) == 1 else b"".join([units[u] for u in f]) for f in split]))
        return [
            b"".join([*map(units.__getitem__, front), *map(parts.__getitem__, words[1:])]) for front, words in zip(fronts, cuts)
        ]


ship_by_value(__name__)
