"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time in numpy.

Words are runs of bytes outside space and TAB..CR, with A-Z lower-cased. A text
with fewer words than the shingle length is one shingle (its whole sequence); a
text without words, or a null text, has none.
"""

from __future__ import annotations

import numpy as np

# Fixed odd 64-bit multipliers of the polynomial and mixing hashes.
_MUL = 0x9E3779B97F4A7C15
_WORD = 0xD6E8FEB86659FD93
_MIX1 = 0xBF58476D1CE4E5B9
_MIX2 = 0x94D049BB133111EB

# Batch size in bytes that one numpy pass works on.
BLOCK_BYTES = 4 << 20
# Bytes whose words are hashed at once: that takes some 50 bytes of memory for each.
WORD_BYTES = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in numpy's wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


def powers(mul: int, n: int) -> np.ndarray:
    """mul**0 .. mul**(n-1) modulo 2**64."""
    out = np.full(n, mul, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    parts, first, held = [], 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > WORD_BYTES:
            parts.append(_word_hashes(texts[first:i]))
            first, held = i, 0
        held += len(text)
    parts.append(_word_hashes(texts[first:]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined, dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    gap = np.empty(len(raw) + 1, dtype=bool)
    gap[0] = True
    gap[1:] = space
    starts = np.flatnonzero(gap[:-1] & ~space)
    counts = np.zeros(len(texts), dtype=np.int64)
    if len(starts) == 0:
        return np.empty(0, dtype=np.uint64), counts
    ends = np.flatnonzero(~gap[1:] & np.append(space[1:], True)) + 1
    lower = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    lengths = ends - starts
    where = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))if starts[0] == 0 else \
        np.concatenate([np.zeros(starts[0], dtype=np.int64),
                        np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))])
    table = powers(_WORD, int(lengths.max()) + 1)
    value = (lower.astype(np.uint64) + np.uint64(1)) * table[np.minimum(where, len(table) - 1)]
    value[space] = 0
    hashes = mix64(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * np.uint64(_MUL))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    of = np.searchsorted(bounds, starts, side="right")
    counts += np.bincount(of, minlength=len(texts))
    return hashes, counts


def shingle_sets(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, back to back; and how many each text has."""
    words, counts = word_hashes(texts)
    n = len(texts)
    if len(words) == 0:
        return np.empty(0, dtype=np.uint64), counts
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    table = powers(_MUL, size)[::-1]
    rolled = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled += words[k:len(words) - size + 1 + k] * table[k]
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(n), per)
    place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + first[owner]
    value = np.empty(len(owner), dtype=np.uint64)
    long = counts[owner] >= size
    value[long] = rolled[place[long]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        part = words[first[i]:first[i] + counts[i]]
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in part:
                h = h * np.uint64(_MUL) + w
            h = h + np.uint64(len(part)) * np.uint64(_WORD)
        value[np.cumsum(per)[i] - 1] = h
    value = mix64(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[keep], np.bincount(owner[keep], minlength=n)


def blocks(texts: list, limit: int = BLOCK_BYTES):
    """(first, encoded texts) runs of at most ``limit`` bytes (one text at least); null is empty."""
    part, first, held = [], 0, 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if part and held + len(raw) > limit:
            yield first, part
            part, first, held = [], i, 0
        part.append(raw)
        held += len(raw)
    if part:
        yield first, part
