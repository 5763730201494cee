"""Counting hashes of documents in fragments of their range.

Documents are handled in blocks (the texts of a few megabytes). A block sends each fragment of the
hash range where it has any one row with its distinct hashes there, and whose they are: a hash that
many documents of the block have is sent once, so however common it is, a fragment gets one entry per
block, and what a block sends grows with its hashes, not with the fragments."""

from __future__ import annotations

import numpy as np


def fragment_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


def times(values: np.ndarray) -> np.ndarray:
    """How often each value stands in the array."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(values) else np.zeros(0, int)
    n = np.diff(np.append(first, len(values)))
    out = np.empty(len(values), np.int64)
    out[order] = np.repeat(n, n)
    return out


def distinct_entries(hashes: np.ndarray, counts: np.ndarray):
    """Of documents' hashes (distinct in each document, end to end): the hashes that one document
    only has, by document, then those that several have, once. Returns (hashes, their number per
    document and last of the shared ones, which of the given hashes are shared)."""
    shared = times(hashes) > 1
    owner = np.repeat(np.arange(len(counts)), counts)
    several = np.unique(hashes[shared])
    own = np.bincount(owner[~shared], minlength=len(counts))
    return np.concatenate([hashes[~shared], several]), np.append(own, len(several)), shared


def fragment_rows(hashes: np.ndarray, counts: np.ndarray, fragments: int, kind: str):
    """For each fragment that has any of the hashes: its number, the document of each hash there, in
    order, and the hashes (their last bytes, as ``kind`` has room for). What is sent follows the
    hashes, however many fragments there are."""
    owner = np.repeat(np.arange(len(counts)), counts)
    of = fragment_of(hashes, fragments)
    order = np.argsort(of, kind="stable")  # within a fragment by document
    of, owner = of[order], owner[order]
    held = hashes[order].astype(kind)
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(of)], strict=False):
        yield int(of[a]), owner[a:b], held[a:b].tobytes()


def packed(numbers: np.ndarray, most: int) -> bytes:
    """Numbers up to ``most`` in two or four bytes each; :func:`unpacked` is told how many."""
    return numbers.astype("<u2" if most < 1 << 16 else "<u4").tobytes()


def unpacked(held: bytes, many: int) -> np.ndarray:
    return np.frombuffer(held, "<u2" if len(held) == 2 * many else "<u4").astype(np.int64)


def joined(parts, kind: str) -> np.ndarray:
    """Arrays from a column of bytes, end to end."""
    return np.frombuffer(b"".join(parts), kind)
