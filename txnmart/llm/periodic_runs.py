"""Periodic runs of words, found by block convolution.

A run is a stretch of a text's words with smallest period ``q`` (words ``q`` apart are the same) and
at least ``max(LEAST, TIMES * q)`` words, that no neighbouring word extends. Periods are sought at
dyadic scales. At scale ``B`` a text is cut into blocks of ``B`` words; for each block a
number-theoretic transform gives the sums of squared differences from the words at every distance of
the window that follows, and a zero is an occurrence. A run of a period from ``B`` to ``2 B - 1`` has
a block whose next occurrence lies one period on, so its distance is among those found (the first
scale, 8, takes periods 1 to 15, as a run has 24 words at least). Chains of blocks that occur again
at one distance are seeds; a seed is extended both ways, word by word in growing strides, to the
longest stretch of that period.

Sums are whole numbers modulo the prime ``PRIME``: a true zero is always found, and words of a
stretch are compared before it counts, so that a sum that is zero by chance alone adds nothing.
Transforms are products with matrices of roots of unity in double precision, where every number stays
below 2^53 and is therefore exact. Occurrences that a known run of a smaller period explains are
passed over, so a text of one repeated word costs no more than another. Blocks grow to ``MOST_BLOCK``
words; longer periods are found in further windows of that width, up to a third of the text.

Each text is handled whole, by the task that reads it; nothing is shuffled. NULL and empty texts have
no words and no runs. Repeated rows each give a row; clashing names of extra columns do no harm.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import slices, words_of

LEAST, TIMES = 24, 3
PRIME, ROOT = 7 * (1 << 20) + 1, 3
FIRST_BLOCK, MOST_BLOCK = 8, 1 << 17
DIRECT = 128  # transforms up to this size are one product, larger ones two
HELD = 1 << 18  # numbers of an array that is worked on at once


def reduced(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2^53 to their residues nearest to zero, in place."""
    x -= PRIME * np.rint(x * (1 / PRIME))
    return x


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """Residues of ``base`` to the given powers, by squaring."""
    out = np.ones(exponents.shape)
    square, rest = float(base), exponents.copy()
    while rest.any():
        out = np.where(rest & 1, reduced(out * square), out)
        square = float(reduced(np.array([square * square]))[0])
        rest >>= 1
    return out


@cache
def roots(size: int, sign: int) -> np.ndarray:
    """The matrix of a transform of a power of two, ``sign`` -1 for the way back (not scaled)."""
    w = pow(ROOT, (PRIME - 1) // size, PRIME)
    k = np.arange(size, dtype=np.int64)
    return _powers(pow(w, sign, PRIME), np.outer(k, k) % size)


@cache
def _twiddles(n1: int, n2: int, sign: int) -> np.ndarray:
    w = pow(ROOT, (PRIME - 1) // (n1 * n2), PRIME)
    return _powers(pow(w, sign, PRIME), np.outer(np.arange(n1, dtype=np.int64), np.arange(n2)))


def _factors(size: int) -> tuple[int, int]:
    half = size.bit_length() // 2
    return 1 << half, size >> half


def transformed(x: np.ndarray, size: int, sign: int) -> np.ndarray:
    """Transforms of the rows of ``x``, shorter ones as if followed by zeros. Above ``DIRECT`` the
    frequencies come as a matrix (k1, k2) of frequency k1 + n1 k2."""
    if size <= DIRECT:
        return reduced(x @ roots(size, sign)[: x.shape[1]])
    n1, n2 = _factors(size)
    rows = np.zeros((len(x), size))
    rows[:, : x.shape[1]] = x
    across = rows.reshape(-1, n1, n2).swapaxes(1, 2).reshape(-1, n1)
    first = reduced(across @ roots(n1, sign)).reshape(-1, n2, n1).swapaxes(1, 2)
    return reduced(reduced(first * _twiddles(n1, n2, sign)).reshape(-1, n2) @ roots(n2, sign)).reshape(-1, n1, n2)


def restored(x: np.ndarray, size: int, many: int) -> np.ndarray:
    """The first ``many`` numbers of the rows that ``x`` transforms."""
    scale = float(pow(size, -1, PRIME))
    if size <= DIRECT:
        return reduced(reduced(x @ roots(size, -1)[:, :many]) * scale)
    n1, n2 = _factors(size)
    first = reduced(x.reshape(-1, n2) @ roots(n2, -1)).reshape(-1, n1, n2)
    across = reduced(first * _twiddles(n1, n2, -1)).swapaxes(1, 2).reshape(-1, n1)
    rows = reduced(across @ roots(n1, -1)).reshape(-1, n2, n1).swapaxes(1, 2).reshape(-1, size)
    return reduced(rows[:, :many] * scale)


def correlated(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, the sums of products of the block with the window at every offset where it
    lies inside."""
    many = windows.shape[1] - blocks.shape[1] + 1
    size = 1 << (windows.shape[1] - 1).bit_length()
    # A block read backwards is the transform with inverse roots.
    both = transformed(windows, size, 1) * transformed(blocks, size, -1)
    return restored(reduced(both), size, many)


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block, first distance, distances) until three periods no longer fit the longest text."""
    block, first, many = FIRST_BLOCK, 1, 2 * FIRST_BLOCK - 1
    while longest >= max(LEAST, TIMES * first):
        yield block, first, many
        first += many
        block = min(2 * block, MOST_BLOCK)
        many = block


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, end to end."""
    ends = np.cumsum(many)
    return np.repeat(start - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)


class Finder:
    """The runs of some texts, whose word numbers stand end to end."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.codes, self.lengths = codes, lengths
        self.starts = np.cumsum(lengths) - lengths
        residues = (codes % PRIME).astype(np.int64)
        self.squares = np.concatenate([[0], np.cumsum(residues * residues % PRIME)])
        self.values = reduced(residues.astype(np.float64))
        self.known: dict[tuple[int, int], tuple[int, int]] = {}  # (start, end): (period, text)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start in the text, length, period) by text, start and period."""
        for scale in scales(int(self.lengths.max(initial=0))):
            self._scale(*scale)
        rows = np.array([(t, s, e, q) for (s, e), (q, t) in self.known.items()], np.int64).reshape(-1, 4)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 1]))]
        text, start, end, period = rows.T
        return text, start - self.starts[text], end - start, period

    def _scale(self, block: int, first: int, many: int) -> None:
        parts = np.flatnonzero(self.lengths >= max(LEAST, TIMES * first))
        number = (self.lengths[parts] - first) // block
        parts, number = parts[number > 0], number[number > 0]
        if not len(parts):
            return
        text = np.repeat(parts, number)
        at = self.starts[text] + block * _ranges(np.zeros(len(number), np.int64), number)
        end = (self.starts + self.lengths)[text]
        covered = self._covered(parts, number, block)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, HELD // (2 * block + many))
        last = len(self.codes) - 1
        for a in range(0, len(at), step):
            x = at[a : a + step]
            window = np.minimum(x[:, None] + first + np.arange(many + block - 1), last)
            sums = correlated(self.values[x[:, None] + np.arange(block)], self.values[window])
            ahead = np.minimum(x[:, None] + first + np.arange(many), last + 1)
            squares = self.squares[np.minimum(ahead + block, last + 1)] - self.squares[ahead]
            squares += (self.squares[x + block] - self.squares[x])[:, None]
            zero = reduced(squares - 2 * sums) == 0
            rows, far = np.nonzero(zero)
            far = far + first
            room = x[rows] + block + far <= end[a + rows]
            rows, far = a + rows[room], far[room]
            if covered is not None and len(rows):
                period, until = covered[0][rows], covered[1][rows]
                told = (period > 0) & (period <= block)
                told[told] = (far[told] % period[told] == 0) & (at[rows[told]] + block + far[told] <= until[told])
                rows, far = rows[~told], far[~told]
            found.append((rows, far))
        rows, far = (np.concatenate(c) for c in zip(*found, strict=True))
        if len(rows):
            self._seeds(rows, far, at, text, block)

    def _covered(self, parts: np.ndarray, number: np.ndarray, block: int):
        """Of each block, the smallest period of the known runs that hold it, and that run's end."""
        if not self.known:
            return None
        of = np.full(len(self.lengths), -1)
        of[parts] = np.cumsum(number) - number
        held = np.full(len(self.lengths), 0)
        held[parts] = number
        rows = np.array([(q, t, s, e) for (s, e), (q, t) in self.known.items()], np.int64)
        rows = rows[of[rows[:, 1]] >= 0]
        q, t, s, e = rows[np.argsort(-rows[:, 0], kind="stable")].T
        low = -(-(s - self.starts[t]) // block)
        high = np.minimum((e - self.starts[t]) // block, held[t])
        many = np.maximum(high - low, 0)
        period, until = np.zeros(number.sum(), np.int64), np.zeros(number.sum(), np.int64)
        at = _ranges(of[t] + low, many)
        # The smallest period is written last.
        period[at], until[at] = np.repeat(q, many), np.repeat(e, many)
        return period, until

    def _seeds(self, rows, far, at, text, block: int) -> None:
        """Chains of neighbouring blocks with occurrences at one distance, extended to stretches."""
        order = np.lexsort((rows, far))
        rows, far = rows[order], far[order]
        new = np.ones(len(rows), bool)
        new[1:] = (far[1:] != far[:-1]) | (rows[1:] != rows[:-1] + 1) | (text[rows[1:]] != text[rows[:-1]])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(rows)) - 1
        far, doc = far[heads], text[rows[heads]]
        start, end = at[rows[heads]], at[rows[tails]] + block
        low, high = self.starts[doc], (self.starts + self.lengths)[doc] - far
        start = start - self._alike(start - 1, far, start - low, -1)
        end = end + self._alike(end, far, high - end, 1)
        enough = end - start >= np.maximum(LEAST - far, (TIMES - 1) * far)
        stretches = np.unique(np.stack([start, end, far, doc], axis=1)[enough], axis=0)
        for s, e, d, t in stretches.tolist():
            self._confirm(s, e, d, t)

    def _alike(self, at, far, room, way: int) -> np.ndarray:
        """For how many words from ``at`` on the text is the same ``far`` words ahead, ``room`` at
        most, going ``way``."""
        out = np.zeros(len(at), np.int64)
        open_, stride = np.flatnonzero(room > 0), 16
        while len(open_):
            rest = []
            step = max(1, HELD // stride)
            for a in range(0, len(open_), step):
                some = open_[a : a + step]
                left = np.minimum(room[some] - out[some], stride)
                go = np.minimum(np.arange(stride), left[:, None] - 1)
                place = at[some][:, None] + way * (out[some][:, None] + go)
                same = self.codes[place] == self.codes[place + far[some][:, None]]
                same &= np.arange(stride) < left[:, None]
                many = np.where(same.all(axis=1), stride, same.argmin(axis=1))
                out[some] += many
                rest.append(some[(many == stride) & (out[some] < room[some])])
            open_, stride = np.concatenate(rest), min(2 * stride, HELD)
        return out

    def _confirm(self, start: int, end: int, far: int, text: int) -> None:
        """Keep the stretches of ``far`` words apart between two places, word for word."""
        breaks = np.flatnonzero(self.codes[start:end] != self.codes[start + far : end + far])
        for a, b in zip([start, *(start + breaks + 1)], [*(start + breaks), end], strict=True):
            if b - a >= max(LEAST - far, (TIMES - 1) * far):
                key = (int(a), int(b) + far)
                if key not in self.known or far < self.known[key][0]:
                    self.known[key] = (far, text)


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(word numbers end to end, words per text, the distinct words)."""
    code: defaultdict[bytes, int] = defaultdict()
    code.default_factory = code.__len__
    parts, lengths = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        for words in words_of(text):
            parts.append(np.fromiter(map(code.__getitem__, words), np.int32, len(words)))
            lengths[i] += len(words)
    code.default_factory = None  # it refers to the table, which would stay until the next collection
    return np.concatenate(parts), lengths, list(code)


Order = Callable[[object, int], np.ndarray | None]


def annotated(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period in words, by start and period) and
    ``collapsed`` (the words of no run beyond its first period, joined by a space) for every row of
    ``docs`` (``doc_id``, ``text``). ``order(doc_id, n)`` may put a text's words in another order
    first: for each place the number of the word that goes there, or None."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", raw=True):
            codes, lengths, names = numbered(texts)
            starts = np.cumsum(lengths) - lengths
            for i, doc_id in enumerate(part.column("doc_id").to_pylist() if order else ()):
                put = order(doc_id, int(lengths[i])) if lengths[i] else None
                if put is not None:
                    own = codes[starts[i] : starts[i] + lengths[i]]
                    own[:] = own[put]
            text, start, length, period = Finder(codes, lengths).runs()
            held = np.zeros(len(codes) + 1, np.int32)
            np.add.at(held, starts[text] + start + period, 1)
            np.add.at(held, starts[text] + start + length, -1)
            kept = np.cumsum(held[:-1]) == 0
            cuts = np.searchsorted(text, np.arange(len(texts) + 1))
            each = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
            named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in each]
            whole = [codes[a : a + n][kept[a : a + n]] for a, n in zip(starts, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(lengths),
                    pa.array([named[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], runs_type),
                    pa.array([b" ".join(map(names.__getitem__, w.tolist())) for w in whole]).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed string",
    )


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The order that makes the end of every tenth text, by a checksum of its id, periodic; None for
    the others and for a NULL id."""
    if doc_id is None or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def run_report(docs: DataFrame) -> DataFrame:
    """The runs of texts as :func:`planted` orders them: their number, the run of the greatest
    exponent, and digests of all runs and of the collapsed text."""
    found = annotated(docs, planted)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    greater = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    # By exponent, compared as whole products; equal ones keep their order, by start and period.
    ahead = lambda a, b: F.when(greater(a, b) != 0, -greater(a, b)).otherwise(
        F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
    )
    best = F.array_sort("runs", lambda a, b: F.signum(ahead(a, b)).cast("int"))
    top = found.withColumn("best", F.try_element_at(best, F.lit(1)))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(
            F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "").cast("binary"), 256
        ).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
