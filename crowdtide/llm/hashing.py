"""64-bit hashes of the words of many texts at once, in numpy.

A word's hash is a polynomial in random numbers of its bytes, taken from running sums over
a whole chunk of text and mixed. Words are runs of other bytes than space, tab and line
feed to carriage return; A-Z count as a-z.
"""

from __future__ import annotations

import functools

CHUNK = 1 << 19  # bytes that are hashed at once, about
STEP = 0x9E3779B97F4A7C15
M1, M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x):
    """A permutation of 64-bit numbers that spreads every bit."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(M2)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _bytes():
    import numpy as np

    value = mixed((np.arange(1, 257, dtype=np.uint64)) * np.uint64(STEP))
    value[ord("A"):ord("Z") + 1] = value[ord("a"):ord("z") + 1]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return value, space


@functools.lru_cache(maxsize=2)
def _powers(n: int):
    import numpy as np

    base, inverse = STEP, pow(STEP, -1, 1 << 64)
    return tuple(np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64)))) for b in (base, inverse))


def _chunk(data: bytes):
    """Hashes of the words of ``data`` and where they start."""
    import numpy as np

    value, space = _bytes()
    b = np.frombuffer(data, np.uint8)
    gap = np.concatenate(([True], space[b], [True]))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    up, down = _powers(1 << max(16, len(data).bit_length()))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[b] * up[:len(b)])))
    return mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def words(texts: list[str]):
    """``hashes, counts``: the words of all texts in a row, and how many each text has.

    Texts are joined up to about ``CHUNK`` bytes; a longer text is cut at white space, so
    memory is that of a chunk, of the longest word, and 8 bytes for each word.
    """
    import numpy as np

    out, counts = [], np.zeros(len(texts), np.int64)
    parts, owner, size = [], [], 0

    def flush():
        nonlocal parts, owner, size
        if parts:
            found, starts = _chunk(b" ".join(parts))
            begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
            own = np.diff(np.searchsorted(starts, begin))
            np.add.at(counts, owner, own)
            out.append(found)
        parts, owner, size = [], [], 0

    for i, text in enumerate(texts):
        data, at = text.encode("utf-8", "surrogatepass"), 0
        while at < len(data) or not at:
            stop = len(data) if len(data) - at <= CHUNK else max(data.rfind(s, at, at + CHUNK) for s in (b" ", b"\n", b"\t", b"\r"))
            if stop <= at:
                stop = min((x for x in (data.find(s, at + CHUNK) for s in (b" ", b"\n", b"\t", b"\r")) if x > 0), default=len(data))
            parts.append(data[at:stop])
            owner.append(i)
            size += stop - at
            at = max(stop, 1)
            if size >= CHUNK:
                flush()
    flush()
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts


def groups(texts, limit: int = CHUNK):
    """Slices of a list of texts that hold about ``limit`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
