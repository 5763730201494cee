"""Sum-of-squares packing of token ids into sequences of one length.

Each task packs the documents of its partition as they come, so nothing is shuffled and no
text leaves its task. Full sequences are cut off a document first. The rest goes to the open
sequence whose fill level makes the sum, over all levels, of the squared number of open
sequences smallest; a level array holds those numbers, so a choice looks at levels, not at
sequences. When ``most_open`` sequences are open, and at the end of the partition, the open
ones are closed: their pieces follow one another, cut at the sequence length, and the last
remainder is cut into powers of two, which need no padding.

A NULL or empty text has the end id only. Ties go to the fullest level, then to the sequence
opened first. Repeated rows are packed each; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import slices

LENGTH = 4096
END_ID = 2
CACHED_WORDS = 350_000


# A word of these Latin letters, with or without punctuation at its end, is lower-cased letter
# by letter and cut into these two parts by the steps named below, and nothing else.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+")
# The steps before the model, as such a vocabulary's file states them.
_STEPS = (
    ["NFC", "Replace", "Lowercase"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "ByteLevel",
)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 bytes stand
    for themselves, the others follow from U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class _Numbers(dict):
    """Numbers words as they come, from 1, and notes the new ones."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        number = self[word] = len(self) + 1
        return number


class WordEncoder:
    """Token ids of texts through a cache of words. The tokenizer never joins what a space
    parts, so a text's ids are those of its words in order. Plain words go to the tokenizer's
    model at once where the steps before it are known; other new words are encoded together,
    parted by a special token of the vocabulary. The cache is emptied when full."""

    TOGETHER = 2048

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = {i: t.content for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        self._part = max(special) if special else -1
        self._parter = special.get(self._part, "")
        self._letters = _byte_letters()
        self._plain = self._steps(path) == _STEPS
        self._clear()

    @staticmethod
    def _steps(path: str):
        """The kinds of normalizers, the splitting pattern and the last pre-tokenizer."""
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        try:
            split, last = parts["pre_tokenizer"]["pretokenizers"]
            kinds = [n["type"] for n in parts["normalizer"]["normalizers"]]
            known = (split["behavior"], split["invert"], last["add_prefix_space"], last["use_regex"])
            if known != ("Removed", True, False, False):
                return None
            return kinds, split["pattern"]["Regex"], last["type"]
        except (KeyError, TypeError, ValueError):
            return None

    def _clear(self) -> None:
        self._numbers = _Numbers()
        self._flat = np.zeros(1 << 16, np.uint32)
        self._starts = np.zeros(1 << 14, np.int64)  # of each word's ids
        self._lengths = np.zeros(1 << 14, np.int64)
        self._used = 0
        self._pieces: dict[bytes, list[int]] = {}

    def _piece(self, text: bytes) -> list[int]:
        """The model's ids of a lower-case piece, through a cache of its own."""
        got = self._pieces.get(text)
        if got is None:
            spelt = text.decode() if text.isascii() else "".join([self._letters[b] for b in text])
            got = self._pieces[text] = [t.id for t in self._tokenizer.model.tokenize(spelt)]
        return got

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        if self._plain:
            plain, rest, ids, ends = [], [], [], []
            for word in words:
                core = word.rstrip(b".,;:!?$%*#&")
                if core.isalpha():  # of ASCII letters
                    own = self._piece(core.lower())
                else:
                    letters = core.decode()
                    if not _PLAIN.fullmatch(letters):
                        rest.append(word)
                        continue
                    own = self._piece(letters.lower().encode())
                ids += own
                if len(core) < len(word):
                    ids += self._piece(word[len(core) :])
                plain.append(word)
                ends.append(len(ids))
            self._add(plain, np.array(ids, np.uint32), np.array(ends, np.int64))
            if len(self._pieces) > CACHED_WORDS // 4:
                self._pieces = {}
            words = rest
        odd = [w for w in words if self._part < 0 or self._parter.encode() in w]
        if odd:
            words = [w for w in words if w not in set(odd)]
        joiner = f" {self._parter} "
        runs = []
        for i in range(0, len(words), self.TOGETHER):
            together = b"\n".join(words[i : i + self.TOGETHER]).decode().replace("\n", joiner)
            runs += self._encode([together + joiner])
        ids = np.array([i for run in runs for i in run], np.uint32)
        cuts = np.flatnonzero(ids == self._part) if self._part >= 0 else np.zeros(0, np.int64)
        self._add(words, np.delete(ids, cuts), cuts - np.arange(len(cuts)))
        for word, own in zip(odd, self._encode([w.decode() for w in odd]), strict=True):
            self._add([word], np.array(own, np.uint32), np.array([len(own)]))

    def _add(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        if not words:
            return
        while self._used + len(ids) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        while len(self._numbers) >= len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._lengths = np.concatenate([self._lengths, np.zeros_like(self._lengths)])
        at = np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words))
        starts = np.append(0, ends[:-1])
        self._starts[at], self._lengths[at] = self._used + starts, ends - starts
        self._flat[self._used : self._used + len(ids)] = ids
        self._used += len(ids)

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each UTF-8 text."""
        if len(self._numbers) > CACHED_WORDS:
            self._clear()
        # ASCII capitals end up as small letters anyhow; special tokens are left as they are.
        fold = (lambda b: b if b"<|" in b else b.lower()) if self._plain else bytes
        number = self._numbers.__getitem__
        runs = []
        for text in texts:
            words = fold(text).split()
            runs.append(np.fromiter(map(number, words), np.int64, len(words)))
        new, self._numbers.new = self._numbers.new, []
        if new:
            self._learn(new)
        for at in runs:
            n = self._lengths[at]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            yield self._flat[np.repeat(self._starts[at] - (ends - n), n) + np.arange(total)]


class LevelPacker:
    """Open sequences by fill level. ``put`` places pieces; ``closed`` gives and forgets the
    pieces of finished sequences, as (doc, start, ids, doc tokens, sequence, offset)."""

    def __init__(self, length: int = LENGTH, most_open: int = 4096):
        self.length, self.most_open = length, most_open
        self.count = np.zeros(length + 1, np.int64)  # open sequences by level
        self._at: dict[int, deque[int]] = {}
        self._pieces: dict[int, list[tuple]] = {}
        self._done: list[tuple] = []
        self._next = 0
        self._open = 0

    def _new(self) -> int:
        self._next += 1
        return self._next - 1

    def _level(self, size: int) -> int:
        """The level (0: a new sequence) that keeps the sum of squares smallest."""
        levels = np.arange(0, self.length - size + 1)
        before, after = self.count[levels], self.count[levels + size]
        # From h to h + s the sum changes by (after + 1)^2 - after^2 + (before - 1)^2 - before^2.
        change = 2 * (after - before) + 2
        if levels[-1] + size == self.length:
            change[-1] = 1 - 2 * before[-1]  # a full sequence is not counted
        change[0] = 2 * after[0] + 1
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return int(levels[::-1][change[::-1].argmin()])

    def put(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.length:
            self._done.append((doc, start, ids[start : start + self.length], total, self._new(), 0))
            start += self.length
        if start == total:
            return
        size = total - start
        level = self._level(size)
        if level:
            sequence = self._at[level].popleft()
            self.count[level] -= 1
        else:
            sequence = self._new()
            self._pieces[sequence] = []
            self._open += 1
        self._pieces[sequence].append((doc, start, ids[start:], total, sequence, level))
        if level + size == self.length:
            self._done += self._pieces.pop(sequence)
            self._open -= 1
        else:
            self._at.setdefault(level + size, deque()).append(sequence)
            self.count[level + size] += 1
        if self._open >= self.most_open:
            self.close()

    def close(self) -> None:
        """Close all open sequences without padding: full ones, then powers of two."""
        pieces = [p for sequence in sorted(self._pieces) for p in self._pieces[sequence]]
        left = sum(len(p[2]) for p in pieces)
        sequence, offset, room = -1, 0, 0
        for doc, start, ids, total, _, _ in pieces:
            while len(ids):
                if not room:
                    room = self.length if left >= self.length else 1 << (left.bit_length() - 1)
                    left -= room
                    sequence, offset = self._new(), 0
                n = min(room, len(ids))
                self._done.append((doc, start, ids[:n], total, sequence, offset))
                ids, start, offset, room = ids[n:], start + n, offset + n, room - n
        self._pieces, self._at, self._open = {}, {}, 0
        self.count[:] = 0

    def closed(self) -> list[tuple]:
        out, self._done = self._done, []
        return out


def pack(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    length: int = LENGTH,
    end_id: int = END_ID,
    most_open: int = 4096,
) -> DataFrame:
    """The pieces of all packed sequences: ``doc_id``, ``start`` (ids of the document before
    it), ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` is the tokenizer file's path, or a function that gives it on an executor.
    Sequence ids hold the partition in their upper bits, so a repeated task repeats them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder = WordEncoder(tokenizer() if callable(tokenizer) else tokenizer)
        packer = LevelPacker(length, most_open)
        upper = TaskContext.get().partitionId() << 40
        doc_type: pa.DataType | None = None

        def rows() -> pa.RecordBatch | None:
            got = packer.closed()
            if not got:
                return None
            doc, start, ids, total, sequence, offset = zip(*got, strict=True)
            columns = [
                pa.array(doc, doc_type),
                pa.array(start, pa.int64()),
                pa.array([np.ascontiguousarray(i, "<u4").tobytes() for i in ids], pa.binary()),
                pa.array(total, pa.int64()),
                pa.array([upper + s for s in sequence], pa.int64()),
                pa.array(offset, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for part, texts in slices(batches, "text", raw=True):
            doc_type = part.column("doc_id").type
            ids_of = encoder.encode(texts)
            for doc, ids in zip(part.column("doc_id").to_pylist(), ids_of, strict=True):
                packer.put(doc, np.append(ids, np.uint32(end_id)))
            if (out := rows()) is not None:
                yield out
        packer.close()
        if (out := rows()) is not None:
            yield out

    schema = f"doc_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def default_tokenizer() -> str:
    """The public vocabulary, looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_report(pieces: DataFrame) -> DataFrame:
    """The digest columns of :func:`pack`'s pieces."""
    return pieces.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
