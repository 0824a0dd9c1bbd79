"""Simple-8b: unsigned integers in 64-bit words, four bits of selector and sixty of values.

A selector says how many values of how many bits its word holds. The last selector is an escape: the
word after it holds one value of any size as it stands. Values are coded in blocks of fixed count, and
the offset of each block's first word is kept, so that any block is found and decoded on its own, and
all blocks can be coded and decoded together, one numpy operation for all words of a selector.
"""
from __future__ import annotations

import numpy as np

BLOCK = 4096
#: (values, bits) of each selector.
LAYOUT = [(60 // bits, bits) for bits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)]
ESCAPE = 15
_COUNT = np.zeros(16, np.int64)
_COUNT[: len(LAYOUT)] = [n for n, _ in LAYOUT]
_COUNT[ESCAPE] = 1


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the offset of the first word of each block with the number of words at the end."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    end = np.minimum((np.arange(0, n, block)) + block, n)
    # The densest selector that fits at each place, as if a word began there.
    choice = np.full(n, ESCAPE, np.uint8)
    for s in range(len(LAYOUT) - 1, -1, -1):
        count, bits = LAYOUT[s]
        if count > n:
            break
        fits = values < (1 << bits) if bits < 8 * values.itemsize else np.ones(n, bool)
        held = 1  # of how many values from here on fits says that they fit
        while held < count and fits.any():
            more = min(held, count - held)
            fits = fits[:len(fits) - more] & fits[more:]
            held += more
        if held == count:
            np.putmask(choice[:len(fits)], fits, s)
    # Words follow each other within a block; all blocks step together.
    at, which = np.arange(0, n, block), np.arange(len(end))
    shorter = np.array([next((t for t, (c, _) in enumerate(LAYOUT) if c <= left), 13) for left in range(61)], np.uint8)
    taken = np.zeros(n, np.uint8)  # the selector, plus one, where a word begins
    while len(at):
        t = choice[at]
        left = end[which] - at
        cut = _COUNT[t] > left  # the block ends before the word is full: fewer values, with more bits each
        if cut.any():
            t[cut] = shorter[left[cut]]
        taken[at] = t + 1
        at = at + _COUNT[t]
        going = at < end[which]
        if not going.all():
            at, which = at[going], which[going]
    at = np.flatnonzero(taken)
    which, s = at // block, taken[at] - 1
    size = 1 + (s == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    wide = values.astype(np.uint64, copy=False)
    for t in np.unique(s):
        here, to = at[s == t], place[s == t]
        words[to] = np.uint64(int(t) << 60)
        if t == ESCAPE:
            words[to + 1] = wide[here]
            continue
        count, bits = LAYOUT[t]
        for k in range(count):
            words[to] |= wide[here + k] << np.uint64(bits * k)
    per_block = np.bincount(which, weights=size, minlength=len(end)).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def decode(words: np.ndarray) -> np.ndarray:
    """The values of whole blocks of words, in order."""
    if not len(words):
        return np.zeros(0, np.uint64)
    s = (words >> np.uint64(60)).astype(np.int64)
    heads = np.arange(len(words))
    escapes = np.flatnonzero(s == ESCAPE)
    if len(escapes):  # the word after an escape is a value, whatever its first bits say
        raw, last = [], -2
        for e in escapes.tolist():
            if e != last + 1:
                raw.append(e + 1)
                last = e
        heads = np.delete(heads, raw)
    s = s[heads]
    n = _COUNT[s]
    start = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint64)
    for t in np.unique(s):
        w, to = heads[s == t], start[s == t]
        if t == ESCAPE:
            out[to] = words[w + 1]
            continue
        count, bits = LAYOUT[t]
        for k in range(count):
            out[to + k] = (words[w] >> np.uint64(bits * k)) & np.uint64((1 << bits) - 1)
    return out
