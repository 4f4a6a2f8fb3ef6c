"""Pre-tokens of the public byte-level vocabularies, found with array operations, and a bounded table of their ids.

The pattern that splits a text (public_tokenizers.PATTERN) is a choice between seven contractions, runs of letters,
digits or other signs with one space before them, and white space. Each choice depends on the class of a few
neighbouring code points only, so all the ends in a text come from comparisons of shifted arrays.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

LETTER, DIGIT, OTHER, SPACE, END = range(5)
#: The white space of the pattern (Unicode's White_Space) and the contractions by their second letter.
WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Code points that are cut at once, and where a text may be divided for that.
PART, BREAK = 1 << 17, re.compile(r"\S ")
SHORT, LONG = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    of = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE] = SPACE
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def cuts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined with a sign of no class after each, its code points, the starts and the ends of the pre-tokens,
    and where each text ends."""
    joined = "\0".join(texts) + "\0"
    point = code_points(joined)
    kind = classes()[point]
    last = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind[last] = END
    cut = np.ones(len(point), bool)  # cut[i]: a pre-token ends before i + 1
    here, after = kind[:-1], kind[1:]
    white, blank = here == SPACE, point[:-1] == 32
    # Two signs of one class stay together; a blank goes with what follows it; other white space before a sign ends.
    cut[:-1] = np.where(white, (after == END) | (after != SPACE) & ~blank, here != after)
    # In a run of white space before a sign the last one stands apart from the rest.
    cut[:-2] |= white[:-1] & (kind[1:-1] == SPACE) & (kind[2:] < SPACE)
    for i in np.flatnonzero(point == 39).tolist():
        if kind[i + 1] == LETTER and (i == 0 or (kind[i - 1] != OTHER and point[i - 1] != 32)):
            size = 2 if joined[i + 1] in SHORT else 3 if joined[i + 1 : i + 3] in LONG else 0
            if size:
                cut[i] = False
                cut[i + size - 1] = True
    cut[last - 1] = True
    stops = np.flatnonzero(cut) + 1
    starts = np.concatenate(([0], stops[:-1]))
    real = kind[starts] != END
    return joined, point, starts[real], stops[real], last


def ends(text: str) -> np.ndarray:
    """The end of each pre-token, in code points."""
    return cuts([text])[3]


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    base = 0x9E3779B97F4A7C15
    whole = lambda x: np.cumprod(np.full(n, x, np.uint64), dtype=np.uint64)
    return whole(base), whole(pow(base, -1, 1 << 64))


def parted(text: str) -> Iterator[str]:
    """Parts of about PART code points. A pre-token always ends between another sign and white space."""
    at = 0
    while len(text) - at > 2 * PART and (found := BREAK.search(text, at + PART)):
        yield text[at : found.start() + 1]
        at = found.start() + 1
    yield text[at:] if at else text


class PieceIds(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers. Starts afresh at `room` entries."""

    def __init__(self, encode: Callable[[str], list[int]], room: int = 400_000):
        super().__init__()
        self.encode, self.room = encode, room

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.room:
            self.clear()
        self[piece] = ids = array("I", self.encode(piece)).tobytes()
        return ids

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has; PART code points at a time, so that memory
        doesn't follow the batch or the longest text."""
        found, many, held, size = [], np.zeros(len(texts), np.int64), [], 0

        def done() -> None:
            ids, n = self.of_part([part for _, part in held])
            found.append(ids)
            np.add.at(many, [i for i, _ in held], n)
            held.clear()

        for i, text in enumerate(texts):
            for part in parted(text):
                held.append((i, part))
                size += len(part)
                if size >= PART:
                    done()
                    size = 0
        if held:
            done()
        return np.concatenate(found) if found else np.empty(0, np.uint32), many

    def of_part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same at once. Each different pre-token is looked up once: pre-tokens meet by a hash, and the code points
        behind equal hashes are compared."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        joined, point, start, stop, last = cuts(texts)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        up, down = powers(1 << (len(point) - 1).bit_length())
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((point + np.uint64(1)) * up[: len(point)], dtype=np.uint64)))
        _, first, which = np.unique((total[stop] - total[start]) * down[start], return_index=True, return_inverse=True)
        size = stop - start
        shift = (start[first][which] - start).astype(np.int32)  # a part is far shorter than 2 ** 31
        like = np.repeat(shift, size)
        at = np.repeat((start - np.concatenate(([0], np.cumsum(size)[:-1]))).astype(np.int32), size) + np.arange(len(like), dtype=np.int32)
        if (size != size[first][which]).any() or (point[at] != point[at + like]).any():  # two pre-tokens with one hash
            first, which = np.arange(len(start)), np.arange(len(start))
        found = [self[joined[a:b]] for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
        ids = np.frombuffer(b"".join(found), "<u4")
        many = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(many) - many
        each = many[which]
        done = np.cumsum(each)
        flat = ids[np.repeat(begin[which] - done + each, each) + np.arange(done[-1])]
        upto = np.concatenate(([0], done))[np.searchsorted(start, last)]
        return flat, np.diff(upto, prepend=0)
