"""Hashes of words and of runs of words, for whole batches of texts at once.

A string's hash is a polynomial modulo 2**64 over tabulated bytes, so every word's hash
comes from two entries of one running sum; runs of words are hashed in the same way over
their words' hashes. A finaliser mixes each result. Texts are read in stretches of about
2 MB that end between words, which bounds memory by the number of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from weft.llm.common import caches

STRETCH = 512 << 10
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(256, dtype=np.uint64), 7)
_BYTES_LOWER = np.concatenate([_BYTES[:65], _BYTES[97:123], _BYTES[91:]])
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
caches["powers"] = _powers.clear


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size, both = 1 << max(10, (n - 1).bit_length()), []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[base] = tuple(both)
    return tuple(p[:n] for p in _powers[base])


def runs_hash(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[begin:end] for each pair; runs of different length differ in it too."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the offsets by text. ``lower``: A-Z count as a-z."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    table = _BYTES_LOWER if lower else _BYTES
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    begins_text = np.zeros(len(data) + 1, bool)
    begins_text[offsets] = True
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + STRETCH)
        while end < len(data) and not begins_text[end] and not _SPACE[data[end]]:
            end += 1
        part = data[at:end]
        space, fresh = _SPACE[part], begins_text[at : end + 1].copy()
        fresh[0] = fresh[-1] = True
        before = np.concatenate([[True], space])
        after = np.concatenate([space, [True]])
        begin = np.flatnonzero(~space & (before[:-1] | fresh[:-1]))
        stop = np.flatnonzero(~space & (after[1:] | fresh[1:])) + 1
        hashes.append(runs_hash(table[part], begin, stop))
        starts.append(begin + at)
        at = end
    begins = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(begins, offsets, "left")


def run_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """Places of the first words of all runs of ``size`` words within one text."""
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    places = np.arange(offsets[0], offsets[-1])
    return places[places + size <= ends]
