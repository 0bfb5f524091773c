"""Words of many texts as 64-bit hashes, computed with array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have if len(have) <= 4 * SLICE else have[: 2 * SLICE]
    return have[:n]


def _pieces(data: bytes) -> Iterator[bytes]:
    """Slices of about a megabyte that end at white space."""
    at = 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            rest = np.frombuffer(data, np.uint8, offset=end)
            while True:
                found = np.flatnonzero(_SPACE[rest[:SLICE]])
                if len(found) or len(rest) <= SLICE:
                    break
                end, rest = end + SLICE, rest[SLICE:]
            end = end + int(found[0]) if len(found) else len(data)
        yield data[at:end]
        at = end


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_FACTOR, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64)), starts


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without white space, A-Z lower-cased) and the number of words per text.

    A word's hash depends on its bytes alone. Two different words share one of 2**64 values only by chance.
    """
    hashes, counts, held, size = [], np.zeros(len(texts), np.int64), [], 0

    def flush() -> None:
        nonlocal held, size
        if held:
            found, starts = _hash_piece(b" ".join(d for _, d in held))
            limits = np.cumsum([len(d) + 1 for _, d in held])
            np.add.at(counts, [k for k, _ in held], np.diff(np.searchsorted(starts, limits), prepend=0))
            hashes.append(found)
        held, size = [], 0

    for k, text in enumerate(texts):
        for piece in _pieces(text.encode().lower()) if text else ():
            held.append((k, piece))
            size += len(piece)
            if size >= SLICE:
                flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def blocks(texts: list[str | None], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` characters."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
