"""Texts as numbers of words, and hashed character n-grams of the distinct words.

Models here see a slice of texts at a time: every distinct word of the slice is described once,
and texts are arrays of its number. Nothing outlives the slice, so memory stays bounded."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

EDGE = b".,;:!?\"'()[]{}<>|*#$%&_-"


def word_numbers(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number of each word in order, words per text, the distinct words)."""
    code: defaultdict[bytes, int] = defaultdict()
    code.default_factory = code.__len__
    lengths = np.zeros(len(texts), np.int64)
    runs = []
    for i, text in enumerate(texts):
        words = (text.lower() if lower else text).encode().split()
        lengths[i] = len(words)
        runs.append(np.fromiter(map(code.__getitem__, words), np.int32, len(words)))
    flat = np.concatenate(runs) if runs else np.zeros(0, np.int32)
    code.default_factory = None  # it refers to the table, which would stay until the next collection
    return flat, lengths, list(code)


def ngrams(words: list[bytes], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams (of UTF-8 bytes) of each word with a space at both ends.

    Returns (buckets, number per word); the grams of a word are adjacent."""
    counts = np.zeros(len(words), np.int64)
    if not words:
        return np.zeros(0, np.int64), counts
    flat = np.frombuffer(b"  ".join([b"", *words, b""]) + b"   ", np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = 1 + np.cumsum(lengths + 2) - (lengths + 2)  # of the leading space
    parts, owners = [], []
    for n in sizes:
        number = np.maximum(lengths + 3 - n, 1)
        ends = np.cumsum(number)
        at = np.repeat(starts - (ends - number), number) + np.arange(ends[-1])
        value = np.full(len(at), n, np.int64)
        for k in range(n):
            value = value * 1_000_003 + flat[at + k]
        parts.append((value ^ (value >> 17)) % buckets)
        owners.append(np.repeat(np.arange(len(words)), number))
        counts += number
    if len(sizes) == 1:
        return parts[0], counts
    owner = np.concatenate(owners)
    return np.concatenate(parts)[np.argsort(owner, kind="stable")], counts


def segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; a run of none is zero."""
    out = np.zeros((len(counts), *values.shape[1:]), values.dtype)
    some = counts > 0
    if some.any():
        ends = np.cumsum(counts)
        out[some] = np.add.reduceat(values, (ends - counts)[some], axis=0)
    return out


def sum_by(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` added up by ``index``."""
    order = np.argsort(index, kind="stable")
    counts = np.bincount(index, minlength=size)
    return segment_sum(values[order], counts)


class Adam:
    """Adam over a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.params[k].dtype)
