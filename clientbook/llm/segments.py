"""Cutting texts for byte-level BPE with the common pattern, so that pieces can be remembered.

No match of the pattern goes from a character that is no white space into a space: a space is
only ever the first character of a match that holds others. Cutting before each space that
follows such a character therefore leaves every match whole, and the pieces can be encoded once each.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

# A space inside a longer run of white space, which the plain cut would split.
_RUN = re.compile(r"\s (?:\s|\Z)|\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
# A word that ends its piece or stands before an ASCII character that is no letter: a match of its own.
_WORD = re.compile(rf" ?[{LATIN}]+(?=[\x00-@\[-`{{-\x7f]|\Z)")


def segments(text: str) -> list[str]:
    """Pieces that joined give the text; each can be encoded on its own."""
    if _RUN.search(text):
        return [piece for piece in _CUT.split(text) if piece]
    first, *others = text.split(" ")
    pieces = [" " + piece for piece in others]
    return [first, *pieces] if first else pieces


# A plain word, or what follows it up to the next space after a character that is no white space. After a word stands
# such a space or a character no word begins with, so a word is only ever found at the beginning of a piece.
_PARTS = re.compile(rf" ?[{LATIN}]++(?![^\x00-@\[-`{{-\x7f])|(?: +[^ ]*|[^ ]+)(?:(?<=\s) +[^ ]*)*")
_PLAIN = re.compile(rf" ?[{LATIN}]+")


def parts(text: str) -> list[str]:
    """The words and rests of all pieces in order; each can be encoded on its own."""
    return _PARTS.findall(text)


def _pairs(letters: list[str]) -> np.ndarray:
    """A table of which two bytes, the first as the higher, end one of these letters; of one byte, whatever stands before it."""
    found = np.zeros((256, 256), bool)
    for last in (letter.encode()[-2:] for letter in letters):
        found[last[0] if len(last) == 2 else slice(None), last[-1]] = True
    return found.ravel()


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for first, last in spans:
        found[first : last + 1] = True
    return found


# Other characters that end in the same two bytes as a white space are taken for one, which only leaves a cut out.
_BLANK = _pairs([c for c in map(chr, range(0x3001)) if c.isspace()])
_LATIN = _pairs([c for c in map(chr, range(0xC0, 0x280)) if c.isalpha()])
# ASCII letters, and the first bytes of the characters from U+00C0 to U+027F, none of which is white space.
_LETTER = _bytes((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9))
_BREAK = _bytes((0x09, 0x0D))


def part_starts(data: np.ndarray, at: np.ndarray, window: int = 1 << 18) -> np.ndarray:
    """Where the parts of many texts begin, and the end; each part can be encoded on its own.

    ``data`` has the UTF-8 bytes of all texts (as uint8), ``at`` the places where they begin, and the end. A cut is made
    before a space after a character that is no white space, around a line break or tab right before a letter, and
    behind the plain word that a part begins with. What would need a look beyond a window stays whole.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    for first in range(0, len(data), window):
        _cut(data[first : first + window], cut[first : first + window])
    return np.flatnonzero(cut)


def _cut(data: np.ndarray, cut: np.ndarray) -> None:
    def pair(place: np.ndarray) -> np.ndarray:
        return data[place - 1].astype(np.uint16) << 8 | data[place]

    space = np.flatnonzero(data[2:] == 0x20) + 2
    cut[space] |= ~_BLANK[pair(space - 1)]
    line = np.flatnonzero(_BREAK[data[:-1]])
    line = line[_LETTER[data[line + 1]] & ~cut[line + 1]]
    cut[line] = cut[line + 1] = True
    letter = _LETTER[data]
    later = np.flatnonzero(data[1:] & 0xC0 == 0x80) + 1
    letter[later] = _LATIN[pair(later)]
    other = np.flatnonzero(~letter)
    before, here = other[:-1], other[1:]
    word = (here - before > 1) & (cut[before] & (data[before] == 0x20) | cut[before + 1])
    cut[here[word & (data[here] < 0x80)]] = True


def is_word(part: str) -> bool:
    """Whether a part is one plain word, with or without a space in front: one match of the pattern."""
    return _PLAIN.fullmatch(part) is not None


def word_and_rest(piece: str) -> tuple[str, str]:
    """The word a piece begins with, and what follows; encodings of both joined are the piece's.

    Words with some punctuation after them are many; words, and what follows them, are few. The
    word is empty where the piece does not begin with one plain Latin word.
    """
    found = _WORD.match(piece)
    end = found.end() if found else 0
    return piece[:end], piece[end:]


class Memo(dict):
    """What ``encode`` makes of each of a list of pieces (a dictionary), worked out once while it is kept.

    Two generations bound the memory: when the young one is full it replaces the old one.
    Pieces over ``longest`` characters are not kept.
    """

    def __init__(self, encode: Callable[[list[str]], dict], most: int = 200_000, longest: int = 64):
        super().__init__()
        self.encode, self.most, self.longest, self.old = encode, most, longest, {}

    def of(self, texts: list[list[str]]) -> list[list]:
        """What the pieces of each text are made into; the unknown ones of all texts are encoded in one call."""
        get, longest = self.get, self.longest
        # Most pieces are known and are looked up once; only the places of the others are gone back to.
        found = [list(map(get, pieces)) for pieces in texts]
        open_ = [[i for i, value in enumerate(values) if value is None] for values in found]
        new = {pieces[i] for pieces, places in zip(texts, open_, strict=True) for i in places}
        if self.old:
            new.difference_update(self.old)
        new = [p for p in new if len(p) <= longest]
        if new:
            self._make_room(len(new))
            self.update(self.encode(new))
        for pieces, values, places in zip(texts, found, open_, strict=True):
            for i in places:
                values[i] = self[pieces[i]]
        return found

    def _make_room(self, more: int) -> None:
        if len(self) + more > self.most:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            found = self.encode([piece])[piece]
            if len(piece) > self.longest:
                return found
        self._make_room(1)
        self[piece] = found
        return found
