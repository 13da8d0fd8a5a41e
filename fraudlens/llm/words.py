"""Words of many texts at once, as numpy arrays of offsets and 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Space, and tab to carriage return.
BLANKS = b" \t\n\v\f\r"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True

#: A longer word is hashed by itself, so that one of megabytes costs no more loops.
LONGEST = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, a blank after each, and where each begins."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return buffer, np.cumsum(sizes) - sizes


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that aren't blank."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = ~_IS_BLANK[buffer]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: int = 0):
    """A 64-bit hash of each span's bytes; with ``prefix``, also one of its
    first bytes, so many at most."""
    length = ends - starts
    state = np.full(len(starts), 0x51ED270B, np.uint64)
    of_prefix = None
    left = np.flatnonzero(length > 0)
    for i in range(LONGEST):
        if prefix and i == prefix:
            of_prefix = state.copy()
        if not len(left):
            break
        state[left] = (state[left] ^ buffer[starts[left] + i]) * _STEP
        state[left] ^= state[left] >> np.uint64(29)
        left = left[length[left] > i + 1]
    if len(left):
        import hashlib

        for k in left.tolist():
            state[k] = int.from_bytes(hashlib.blake2b(buffer[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    out = mixed(state + length.astype(np.uint64))
    if not prefix:
        return out
    return out, mixed(of_prefix if of_prefix is not None else state)


def owners(starts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The number of the text that each span lies in."""
    return np.searchsorted(begins, starts, side="right") - 1


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive hashes, in their order."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * _STEP + hashes[i : len(hashes) - n + 1 + i]
        out ^= out >> np.uint64(32)
    return mixed(out)
