"""Hashed word shingles of whole texts, vectorised over bytes."""

from __future__ import annotations

import numpy as np

U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
#: A fixed odd multiplier and one 64-bit value for each byte.
BASE = 0xD6E8FEB86659FD93
BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
#: ASCII capitals to small letters; and the bytes that end a word.
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse modulo 2^64."""
    inverse = pow(BASE, -1, 1 << 64)
    up = np.cumprod(np.full(n, BASE, dtype=np.uint64)) if n else np.empty(0, np.uint64)
    down = np.cumprod(np.full(n, inverse, dtype=np.uint64)) if n else np.empty(0, np.uint64)
    return up, down


UP, DOWN = _powers(CHUNK)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word `[^\\x20\\x09-\\x0D]+`, A-Z in lower case, in order."""
    raw = SMALL[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    gap = SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    # Prefix sums of byte values times powers; a word's hash is a difference, moved to its start.
    value = BYTES[raw]
    for at in range(0, len(raw), CHUNK):
        value[at : at + CHUNK] *= UP[: min(CHUNK, len(raw) - at)]
    with np.errstate(over="ignore"):
        sums = np.concatenate(([U(0)], np.cumsum(value, dtype=np.uint64)))
        # Powers start anew in each chunk: words across a boundary are summed piece by piece.
        first = starts // CHUNK
        last = (ends - 1) // CHUNK
        out = (sums[ends] - sums[starts]) * DOWN[starts % CHUNK]
        for i in np.flatnonzero(first != last):
            word = BYTES[raw[starts[i] : ends[i]]]
            total = 0
            for at in range(0, len(word), CHUNK):
                part = word[at : at + CHUNK]
                moved = int((part * UP[: len(part)]).sum(dtype=np.uint64))
                total += moved * pow(BASE, at, 1 << 64)
            out[i] = U(total * pow(BASE, -1, 1 << 64) % (1 << 64))
        return mix(out + (ends - starts).astype(np.uint64) * STEP)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `k` words; fewer words are one run; none is empty."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, U(k))
    for i in range(k):
        out = mix(out * STEP + words[i : i + n])
    return np.unique(out)
