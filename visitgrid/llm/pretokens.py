"""Pre-tokens of the byte-level vocabularies, found for many texts at once.

The split is that of ``public_tokenizers.PATTERN``.  Instead of a regular expression
that walks each text, code points are mapped to four classes and the places where a
pre-token starts follow from the classes of neighbours:

* a run of letters, of numbers or of other marks is one pre-token, with one U+0020 before it;
* of white space before something else the last character stands alone (or is that U+0020);
* an apostrophe that starts a run takes ``s t m d re ve ll`` with it.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

from .words import factors

LETTER, NUMBER, OTHER, SPACE, END = 1, 2, 0, 3, 4


@functools.cache
def class_table() -> np.ndarray:
    """Class of each code point, as the ``regex`` library has it."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    classes = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            classes[np.frombuffer(found[0].encode("utf-32-le"), np.uint32)] = kind
    return classes


def _split(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, their code points, start and end of each pre-token, counts by text."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = class_table()[points]
    kinds[ends] = END
    before = np.empty_like(kinds)
    before[0], before[1:] = END, kinds[:-1]
    after = np.empty_like(kinds)
    after[-1], after[:-1] = END, kinds[1:]
    space = kinds == SPACE
    led = np.zeros(len(points), bool)  # preceded by the one blank that belongs to it
    led[1:] = points[:-1] == 32
    starts = (kinds != before) & (space | ~led | (kinds == END))
    starts |= space & (after != SPACE) & (after != END)
    starts[1:][kinds[:-1] == END] = True
    marks = np.flatnonzero((points == 39) & starts & (after == LETTER))
    if len(marks):
        padded = np.append(points, np.zeros(3, np.uint32))
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
        long = np.zeros(len(marks), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        starts[marks[short | long] + 1] = False
        starts[marks[short] + 2] = True
        starts[marks[long] + 3] = True
    starts[ends] = True
    places = np.flatnonzero(starts)
    stops = np.append(places[1:], len(points))
    real = kinds[places] != END
    counts = np.diff(np.flatnonzero(~real), prepend=-1) - 1
    return joined, points, places[real], stops[real], counts


def pretokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts in order, and how many each text has."""
    if not texts:
        return [], np.zeros(0, np.int64)
    joined, _, starts, stops, counts = _split(texts)
    return [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())], counts


def distinct_pretokens(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens, for each pre-token in order which of them it is, and how many
    pre-tokens each text has."""
    if not texts:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined, points, starts, stops, counts = _split(texts)
    return *_distinct(joined, points, starts, stops), counts


def distinct_segments(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same for segments: from a U+0020 that does not follow white space to the next.

    No pre-token goes on over such a place.  Texts start with a segment whatever they start with.
    """
    if not texts:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    starts = np.zeros(len(points) + 1, bool)
    starts[1:-1] = (points[1:] == 32) & (class_table()[points[:-1]] != SPACE)
    starts[ends + 1] = True
    starts[0] = True
    starts[ends] = True  # the mark behind each text, left out below
    places = np.flatnonzero(starts[:-1])
    stops = np.append(places[1:], len(points))
    real = np.ones(len(places), bool)
    real[np.searchsorted(places, ends)] = False
    counts = np.diff(np.flatnonzero(~real), prepend=-1) - 1
    return *_distinct(joined, points, places[real], stops[real]), counts


def _distinct(joined: str, points: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct slices, and which of them each slice is.

    Only the distinct ones become strings: equal ones are found by a 64-bit hash, and a
    second hash confirms it (should it ever not, the strings are compared).
    """
    if not len(starts):
        return [], np.zeros(0, np.int64)
    sizes = stops - starts
    ends = np.cumsum(sizes)
    place = np.arange(int(ends[-1])) - np.repeat(ends - sizes, sizes)
    terms = points[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(1)
    longest = int(sizes.max())
    one, two = (np.add.reduceat(terms * factors(longest, seed)[place], ends - sizes) for seed in (7, 8))
    _, first, which = np.unique(one, return_index=True, return_inverse=True)
    if not np.array_equal(two[first][which], two):
        words = [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        known = {w: n for n, w in enumerate(dict.fromkeys(words))}
        return list(known), np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return [joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())], which


def gather(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``which`` of a ragged table (``values`` cut by ``sizes``), end to end, and
    where each ends."""
    begins = np.cumsum(sizes) - sizes
    taken = sizes[which]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begins[which] - (ends - taken), taken) + np.arange(total)], ends


def by_text(ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where each text's part ends, given where each of its pre-tokens' parts ends."""
    return np.append(0, ends)[np.cumsum(counts)]
