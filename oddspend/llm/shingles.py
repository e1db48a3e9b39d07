"""Word n-gram sets and their MinHash bands, in NumPy inside tasks."""

import functools
import hashlib
import math

import numpy as np

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = 0x100000001B3  # odd, so that its powers have inverses modulo 2^64


def choose_bands(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows to a band for which pairs at the threshold are found with
    the wanted recall, 1 - (1 - threshold^rows)^bands, by at most so many hashes."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word `[^\\x20\\x09-\\x0D]+`."""
    data = np.frombuffer(text.encode(), np.uint8)
    inside = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    return mixed((sums[last] - sums[first]) * down[first])


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a text of fewer words is one n-gram."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(BASE) + words[k : len(words) - width + 1 + k])
    return np.unique(out)


@functools.lru_cache(maxsize=4)
def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 64, n, np.uint64)[:, None], (rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit hash for each band of the MinHash signature."""
    xor, factor = _seeds(bands * rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):  # long texts in parts, to bound memory
        np.minimum(least, ((found[None, at : at + 4096] ^ xor) * factor).min(axis=1), out=least)
    out = np.zeros(bands, np.uint64)
    for k in range(rows):
        out = mixed(out * np.uint64(BASE) + least[k::rows])
    return out.view(np.int64)


def set_key(found: np.ndarray) -> bytes:
    """16 bytes that tell n-gram sets apart."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()
