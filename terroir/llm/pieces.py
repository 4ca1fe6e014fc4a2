"""Cutting a text where no token of the GPT-2 split pattern can cross, to encode equal pieces once.

A token of that pattern holds a space only as its first character or inside a run of white space that ends before
the run's last character or at the text's end. So a cut before any space that a visible character follows never
changes the tokens. Pieces are mostly words; their encodings are kept in a dictionary of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries after which a dictionary keeps only those in use: some 100 MB with their encodings.
KEPT = 500_000

#: A letter and one of these are never in one token.
MARKS = frozenset(",.;:!?")

_LATE_SPACE = re.compile(r" (?=\s|$)")
_CUT = re.compile(r" (?=\S)")


def pieces(text: str) -> list[str]:
    """The pieces of ``text`` in order; each but the first has lost the space that it starts with."""
    return _CUT.split(text) if _LATE_SPACE.search(text) else text.split(" ")


def retained(known: dict[str, bytes], needed: set[str]) -> dict[str, bytes]:
    """What of a full dictionary stays: the entries just needed, among them the frequent ones."""
    return {piece: known[piece] for piece in needed if piece in known}


@dataclass(frozen=True)
class Split:
    """Texts as numbers of their distinct pieces: Arrow splits and numbers them.

    ``order`` names the texts that aren't empty, ``ends`` where each one's numbers end. A number below the length of
    ``words`` is a piece that has lost its space, the others are the distinct first pieces ``firsts``.
    """

    order: list[int]
    ends: np.ndarray
    number: np.ndarray
    words: pa.Array
    firsts: list[str]

    @staticmethod
    def of(texts: list[str]) -> Split | None:
        """None if all texts are empty."""
        late = [bool(text) and _LATE_SPACE.search(text) is not None for text in texts]
        plain = [i for i, text in enumerate(texts) if text and not late[i]]
        others = [i for i, text in enumerate(texts) if late[i]]
        split = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        lists = [_CUT.split(texts[i]) for i in others]
        rest = pa.array([p for parts in lists for p in parts], pa.large_string())
        ends = np.cumsum([*np.diff(split.offsets.to_numpy()), *map(len, lists)]).astype(np.int64)
        if not len(ends):
            return None
        numbered = pa.concat_arrays([split.values, rest]).dictionary_encode()
        number, words = numbered.indices.to_numpy().astype(np.int64), numbered.dictionary
        starts = np.r_[0, ends[:-1]]
        firsts = [words[i].as_py() for i in number[starts].tolist()]
        distinct = {p: len(words) + k for k, p in enumerate(dict.fromkeys(firsts))}
        number[starts] = [distinct[p] for p in firsts]
        return Split([*plain, *others], ends, number, words, list(distinct))

    def used(self) -> np.ndarray:
        """Which of ``words`` are pieces other than first ones."""
        used = np.zeros(len(self.words), bool)
        used[self.number[self.number < len(used)]] = True
        return used

    def joined(self, n: int, used: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The ``n`` texts' ids, from the ids ``data`` of the used words and the first pieces, ``sizes`` of them each."""
        place = np.r_[np.cumsum(used) - 1, int(used.sum()) + np.arange(len(self.firsts))]
        number = place[self.number]
        lengths = sizes[number]
        upto = np.cumsum(lengths)
        shift = (np.cumsum(sizes) - sizes)[number] - (upto - lengths)
        whole = data[np.repeat(shift, lengths) + np.arange(upto[-1])]
        stops = upto[self.ends - 1].tolist()
        made = dict(zip(self.order, zip([0, *stops[:-1]], stops, strict=True), strict=True))
        return [whole[slice(*made[i])].tobytes() if i in made else b"" for i in range(n)]


class Encodings:
    """Encodings of texts as bytes, by way of the encodings of their distinct pieces.

    ``encode`` gives the encodings of many pieces at once. A first piece is looked up with a leading mark, since it
    lacks the space of the others. ``kept`` bounds the dictionary, by default ``KEPT``; ``unit`` is the bytes of an id.
    """

    FIRST = "\x00first\x00"

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        kept: int | None = None,
        unit: int = 1,
    ):
        self._encode, self._kept, self._unit = encode, kept, unit
        self._known: dict[str, bytes] = {}

    def of_many(self, texts: list[str]) -> list[bytes]:
        """The encodings of texts."""
        split = Split.of(texts)
        if split is None:
            return [b""] * len(texts)
        used = split.used()
        firsts = [self.FIRST + p for p in split.firsts]
        keys = [*split.words.filter(pa.array(used)).to_pylist(), *firsts]
        self._know(set(keys))
        encoded = list(map(self._known.__getitem__, keys))
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // self._unit
        return split.joined(len(texts), used, np.frombuffer(b"".join(encoded), f"u{self._unit}"), sizes)

    def _know(self, needed: set[str]) -> None:
        """Learn the pieces of ``needed`` that aren't in the dictionary."""
        new = needed.difference(self._known)
        if len(new) + len(self._known) > (self._kept or KEPT):
            self._known = retained(self._known, needed)
        # A word and the mark at its end are encoded apart: the word is often known already.
        marked = [p for p in new if p[-1:] in MARKS and p[-2:-1].isalpha()]
        plain = new.difference(marked)
        plain.update([p[:-1] for p in marked], [self.FIRST + p[-1] for p in marked])
        self._learn(list(plain.difference(self._known)))
        known = self._known
        known.update([(p, known[p[:-1]] + known[self.FIRST + p[-1]]) for p in marked])

    def forget(self) -> None:
        self._known = {}

    def _learn(self, new: list[str]) -> None:
        mark = len(self.FIRST)
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            texts = [p[mark:] if p.startswith(self.FIRST) else " " + p for p in part]
            self._known.update(zip(part, self._encode(texts), strict=True))


def grouped(texts: list[str], characters: int = 4_000_000):
    """Slices of ``texts`` with about so many characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]
