"""Words of UTF-8 texts as numpy arrays: where they are and a 64-bit hash of each."""

from collections.abc import Iterator

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPAN = 1 << 19

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        ones = np.ones(size, np.uint64)
        up, down = ones * BASE, ones * INVERSE
        up[0] = down[0] = 1
        if size > 4 * SPAN:  # a single very long word: not worth keeping
            return np.cumprod(up), np.cumprod(down)
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bounds(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without blanks."""
    inside = np.zeros(len(octets) + 2, np.int8)
    inside[1:-1] = ~BLANK[octets]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hashes(octets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each slice: a polynomial taken from running sums, then mixed with the length."""
    up, down = powers(len(octets) + 1)
    sums = np.zeros(len(octets) + 1, np.uint64)
    np.cumsum((octets.astype(np.uint64) + np.uint64(1)) * up[: len(octets)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def spans(raw: bytes) -> Iterator[np.ndarray]:
    """The text in runs of about ``SPAN`` bytes, cut at blanks only."""
    octets = np.frombuffer(raw, np.uint8)
    at = 0
    while at < len(octets):
        end = at + SPAN
        while end < len(octets):
            blank = np.flatnonzero(BLANK[octets[end : end + SPAN]])
            if len(blank):
                end += int(blank[0])
                break
            end += SPAN
        yield octets[at:end]
        at = end


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word of a whole text, in order."""
    parts = []
    for octets in spans(raw):
        starts, ends = bounds(octets)
        if len(starts):
            parts.append(hashes(octets, starts, ends))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words; of the whole sequence if it is shorter; none without words."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * BASE + words[i : i + n]
    return mix(total + np.uint64(width))
