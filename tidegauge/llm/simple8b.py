"""Simple-8b: runs of integers packed into 64-bit words, coded and decoded without a loop per id.

A word's top four bits select how many integers of which width its other 60 bits hold, so widths
follow the ids at hand. An integer of more than 60 bits is an escape: its word holds its number
among the raw 64-bit integers that are kept behind the words of its run.
"""

from __future__ import annotations

import numpy as np

#: Bits of an integer by selector 1 to 14; a word holds 60 // bits of them. 15 is the escape.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
#: Integers that are packed at a time.
PIECE = 16_384
_POWERS = np.uint64(1) << np.arange(61, dtype=np.uint64)
#: Bits of the integers that most vocabularies stay below.
_SMALL_BITS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8)
_SHIFT = np.uint64(60)
_PAYLOAD = (np.uint64(1) << _SHIFT) - np.uint64(1)
#: Integers in a word, by selector.
COUNTS = np.array([0, *(60 // w for w in WIDTHS), 1], np.int64)


def pack(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of consecutive runs of integers, with the number of words and of escapes per run.

    No word spans two runs; the escapes of a run stand behind its words and count as words. Every
    word takes as many integers as one selector can hold. A run may be empty and then has no word.
    """
    values, lengths = np.asarray(values), np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    parts, run, at = [], 0, 0
    while run < len(ends):
        # pieces of whole runs that stay in the processor's cache
        to = max(run + 1, int(np.searchsorted(ends, at + PIECE, side="right")))
        some = np.asarray(values[at : ends[to - 1]], np.uint64)
        parts.append(_pack(some, lengths[run:to]))
        run, at = to, int(ends[to - 1])
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _pack(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths, dtype=np.int64)
    size = len(values)
    if not size:
        none = np.zeros(len(ends), np.int64)
        return np.zeros(0, np.uint64), none, none
    # the widest integer among the next k of a run; its end counts as no bits at all
    left = np.minimum(np.repeat(ends, lengths) - np.arange(size), 60).astype(np.int8)
    if values.max() < len(_SMALL_BITS):
        bits = _SMALL_BITS[values]
    else:
        bits = np.searchsorted(_POWERS, values, side="right").astype(np.int8)
    widest = bits.copy()
    selector = np.full(size, ESCAPE, np.int8)
    seen, before = 1, 0
    for number, width in reversed(list(enumerate(WIDTHS, 1))):
        for k in range(seen, min(COUNTS[number], size)):
            inside = np.where(left[: size - k] > k, bits[k:], np.int8(0))
            np.maximum(widest[: size - k], inside, out=widest[: size - k])
        seen = max(seen, COUNTS[number])
        # a narrower selector only helps where more integers are left than a wider one holds
        fits = (widest <= width) & (left > before)
        before = COUNTS[number]
        if not fits.any():
            break  # what fits a narrower selector fits a wider one too
        np.copyto(selector, np.int8(number), where=fits)
    taken = np.minimum(COUNTS.astype(np.int8)[selector], left)
    steps, places, at = taken.tobytes(), [], 0
    while at < size:
        places.append(at)
        at += steps[at]
    first = np.array(places, np.int64)
    selector, taken = selector[first], taken[first]
    words = selector.astype(np.uint64) << _SHIFT
    shift = np.array([0, *WIDTHS, 0], np.uint64)[selector]
    some = np.flatnonzero(selector != ESCAPE)
    for k in range(int(taken.max())):
        some = some[taken[some] > k]
        words[some] |= values[first[some] + k] << (np.uint64(k) * shift[some])
    n_words = np.diff(np.searchsorted(first, ends), prepend=0)
    escaped = np.flatnonzero(selector == ESCAPE)
    if not len(escaped):
        return words, n_words, np.zeros(len(ends), np.int64)
    run = np.searchsorted(ends, first[escaped], side="right")
    n_escapes = np.bincount(run, minlength=len(ends))
    before = np.cumsum(n_escapes) - n_escapes
    words[escaped] |= (np.arange(len(escaped)) - before[run]).astype(np.uint64)
    behind = np.cumsum(n_words)[run]
    return np.insert(words, behind, values[first[escaped]]), n_words + n_escapes, n_escapes


def unpack(
    words: np.ndarray, n_words: np.ndarray, n_escapes: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """The integers of consecutive runs, from what ``pack`` gave and the runs' lengths."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(n_words, dtype=np.int64)
    plain = np.ones(len(words), bool)
    raw_at = ends - n_escapes
    if np.any(n_escapes):
        plain[np.concatenate([np.arange(a, b) for a, b in zip(raw_at, ends, strict=True)])] = False
    at = np.flatnonzero(plain)
    selector = (words[at] >> _SHIFT).astype(np.int64)
    payload = words[at] & _PAYLOAD
    counts = COUNTS[selector]
    # the last word of a run may hold fewer integers than its selector says
    last = np.cumsum(n_words - n_escapes) - 1
    filled = n_words > 0
    held = np.add.reduceat(counts, np.flatnonzero(_starts(n_words - n_escapes))) if len(counts) else counts
    counts[last[filled]] -= held - lengths[filled]
    begin = np.cumsum(counts) - counts
    values = np.zeros(int(lengths.sum()), np.uint64)
    for number, width in enumerate(WIDTHS, 1):
        mine = np.flatnonzero(selector == number)
        mask = np.uint64((1 << width) - 1)
        for k in range(COUNTS[number] if len(mine) else 0):
            some = mine[counts[mine] > k]
            values[begin[some] + k] = (payload[some] >> np.uint64(k * width)) & mask
    escaped = np.flatnonzero(selector == ESCAPE)
    if len(escaped):
        run = np.searchsorted(ends, at[escaped], side="right")
        values[begin[escaped]] = words[raw_at[run] + payload[escaped].astype(np.int64)]
    return values


def _starts(n_words: np.ndarray) -> np.ndarray:
    """A mark on the first word of every run that has words."""
    marks = np.zeros(int(n_words.sum()), bool)
    marks[(np.cumsum(n_words) - n_words)[n_words > 0]] = True
    return marks
