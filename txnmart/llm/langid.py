"""Language identification: a linear-chain conditional random field over words.

A word's features are its prefixes and suffixes of one to three bytes, its byte 2- and 3-grams,
and the languages whose learned lexicon holds it. Feature weights and the transitions between
languages of neighbouring words are trained together by the likelihood of label sequences; the
training sequences join passages of several languages, so changes inside a text are learned.
Texts shorter than a passage are learned from whole.
Forward-backward gives each word's label probabilities; a document's language is the one with
the largest sum over its words.

Training takes a bounded sample of documents with a language (``SAMPLE``, one row per id, and
``BYTES`` of text) on the driver.
Labelling is a map over partitions: the texts of a slice are laid end to end in lanes, which
are walked in parallel, with the chain cut between texts.

NULL texts and texts without a letter are ``und`` with score 0, and so is everything when
nothing could be learned. A letter is what Unicode calls one (``½`` and ``①`` are none). A NULL id is
neither held out nor learned from. Ties go to the first language by name. Repeated rows each give a row;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import bounded_rows, bounded_sample, fold, slices
from txnmart.llm.wordtables import EDGE, Adam, ngrams, segment_sum, sum_by, word_numbers

SAMPLE = 2000
BYTES = 64_000_000  # of texts to learn from
HOLD_OUT, FOLDS = 1, 3
BUCKETS = 1 << 15
UNKNOWN = "und"


def _affixes(words: list[bytes]) -> np.ndarray:
    """Six feature numbers per word: prefixes and suffixes of one to three bytes."""
    out = np.zeros((len(words), 6), np.int64)
    if words:
        edge = np.array([(w[:3] + b"   ")[:3] + (b"   " + w)[-3:] for w in words], "S6")
        c = np.frombuffer(edge.tobytes(), np.uint8).reshape(-1, 6).astype(np.int64)
        value = np.zeros(len(words), np.int64)
        for k in range(3):
            value = value * 257 + c[:, k]
            out[:, k] = value * 8 + k
        value = np.zeros(len(words), np.int64)
        for k in range(3):
            value = value * 257 + c[:, 5 - k]
            out[:, 3 + k] = value * 8 + 3 + k
    return (out ^ (out >> 15)) % BUCKETS


class Field:
    """The fitted model: ``languages``, feature weights, lexicon, transitions, start."""

    def __init__(self, languages: list[str], lexicon: dict[bytes, int]):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.p = {
            "gram": np.zeros((BUCKETS, k)),
            "affix": np.zeros((BUCKETS, k)),
            "lexicon": np.zeros((k + 1, k)),
            "trans": np.zeros((k, k)),
            "start": np.zeros(k),
        }

    def describe(self, words: list[bytes]):
        bare = [w.strip(EDGE) for w in words]
        grams, counts = ngrams(bare, (2, 3), BUCKETS)
        listed = np.fromiter((self.lexicon.get(w, len(self.languages)) for w in bare), np.int64, len(bare))
        return grams, counts, _affixes(bare), listed

    def emissions(self, described) -> np.ndarray:
        """Each distinct word's score per language."""
        grams, counts, affixes, listed = described
        mean = segment_sum(self.p["gram"][grams], counts) / np.maximum(counts, 1)[:, None]
        return 4 * mean + self.p["affix"][affixes].sum(axis=1) + self.p["lexicon"][listed]

    def gradients(self, described, d: np.ndarray) -> dict[str, np.ndarray]:
        grams, counts, affixes, listed = described
        per_gram = np.repeat(4 * d / np.maximum(counts, 1)[:, None], counts, axis=0)
        return {
            "gram": sum_by(grams, per_gram, BUCKETS),
            "affix": sum_by(affixes.ravel(), np.repeat(d, 6, axis=0), BUCKETS),
            "lexicon": sum_by(listed, d, len(self.languages) + 1),
        }


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Label probabilities by forward-backward, for lanes walked side by side.

    ``emit`` (steps, lanes, labels) are non-negative factors; ``first`` (steps, lanes) marks
    where a new text begins; ``trans`` and ``start`` are factors too. Returns the
    probabilities, and the forward and backward messages."""
    steps, lanes, k = emit.shape
    ahead = np.empty_like(emit)
    at = np.broadcast_to(start, (lanes, k))
    for t in range(steps):
        into = start if t == 0 else at @ trans
        if t and first[t].any():
            into = np.where(first[t][:, None], start, into)
        at = _unit(into * emit[t])
        ahead[t] = at
    back = np.empty_like(emit)
    at = np.ones((lanes, k))
    back[steps - 1] = at
    for t in range(steps - 2, -1, -1):
        at = _unit((emit[t + 1] * back[t + 1]) @ trans.T)
        if first[t + 1].any():
            at = np.where(first[t + 1][:, None], 1.0, at)
        back[t] = at
    return _unit(ahead * back), ahead, back


def lanes_of(lengths: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Lane and first step of each text: filled one after the other up to ``steps`` (at least
    the longest text)."""
    lane, at = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    now = used = 0
    for i in np.argsort(-lengths, kind="stable"):
        if used and used + lengths[i] > steps:
            now, used = now + 1, 0
        lane[i], at[i] = now, used
        used += lengths[i]
    return lane, at


def label_words(model: Field, flat: np.ndarray, lengths: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of texts laid end to end."""
    total = int(lengths.sum())
    k = len(model.languages)
    if not total:
        return np.zeros((0, k))
    steps = max(int(lengths.max()), -(-total // 512))
    lane, at = lanes_of(lengths, steps)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    step = at[owner] + np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    factors = np.exp(emit - emit.max(axis=1, keepdims=True))
    grid = np.ones((steps, int(lane.max()) + 1, k))
    grid[step, lane[owner]] = factors[flat] + 1e-30
    first = np.zeros(grid.shape[:2], bool)
    some = lengths > 0
    first[at[some], lane[some]] = True
    # What follows a lane's last text is apart from it.
    after = at + lengths
    inside = after < steps
    first[after[inside], lane[inside]] = True
    got, _, _ = marginals(grid, first, np.exp(model.p["trans"]), np.exp(model.p["start"]))
    return got[step, lane[owner]]


def letter_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """:func:`word_numbers` of the words that have a letter."""
    flat, lengths, words = word_numbers(texts)
    has = np.fromiter((any(map(str.isalpha, w.decode())) for w in words), bool, len(words))
    keep = has[flat]
    owner = np.repeat(np.arange(len(texts)), lengths)
    number = np.cumsum(has) - 1
    kept = np.bincount(owner[keep], minlength=len(texts)) if len(texts) else lengths
    return number[flat[keep]], kept, [w for w, h in zip(words, has, strict=True) if h]


def build_lexicon(words: list[bytes], by_language: np.ndarray, least: int = 4, share: float = 0.9):
    """Words that stand ``least`` times and nearly always in one language, with its number."""
    total = by_language.sum(axis=1)
    top = by_language.argmax(axis=1)
    sure = (total >= least) & (by_language.max(axis=1) >= share * total)
    return {words[i].strip(EDGE): int(top[i]) for i in np.flatnonzero(sure)}


def train(
    texts: list[str], langs: list[str], epochs: int = 3, passage: int = 20, joined: int = 3, seed: int = 9
) -> Field | None:
    """Fit the field to documents of one language each."""
    languages = sorted(set(langs))
    flat, lengths, words = letter_words(texts)
    if not len(flat) or not languages:
        return None
    number = {n: i for i, n in enumerate(languages)}
    label = np.array([number[n] for n in langs])
    owner = np.repeat(np.arange(len(texts)), lengths)
    k = len(languages)
    by_language = np.bincount(flat * k + label[owner], minlength=len(words) * k).reshape(-1, k)
    model = Field(languages, build_lexicon(words, by_language))
    adam = Adam(model.p, 0.05)
    rng = np.random.default_rng(seed)
    # Passages of ``passage`` words from anywhere in the text; shorter texts come whole.
    first = np.cumsum(lengths) - lengths
    usable = np.flatnonzero(lengths)
    for epoch in range(epochs):
        adam.rate = 0.05 * (1 - epoch / epochs)
        # Each document gives up to eight passages per epoch.
        docs = np.repeat(usable, np.clip(lengths[usable] // passage, 1, 8))
        rng.shuffle(docs)
        size = np.minimum(lengths[docs], passage)
        start = first[docs] + (rng.random(len(docs)) * (lengths[docs] - size + 1)).astype(np.int64)
        at, y = _sequences(start, size, label[docs], joined)
        for i in range(0, len(at), 64):
            _step(model, adam, flat, words, at[i : i + 64], y[i : i + 64])
    return model


def _sequences(start: np.ndarray, size: np.ndarray, label: np.ndarray, joined: int):
    """Places and labels of the words of ``joined`` passages after each other, a row each; a place
    of -1 is after the end."""
    owner = np.arange(len(start)) // joined
    total = np.bincount(owner, size).astype(np.int64)
    before = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(before, size)
    row = np.repeat(owner, size)
    column = np.arange(size.sum()) - (np.cumsum(total) - total)[row]
    at = np.full((len(total), int(total.max())), -1)
    at[row, column] = np.repeat(start, size) + within
    y = np.zeros(at.shape, np.int64)
    y[row, column] = np.repeat(label, size)
    return at, y


def _step(model: Field, adam: Adam, flat, words, at, y) -> None:
    k = len(model.languages)
    at = at[:, : int((at >= 0).sum(axis=1).max())].T
    y = y[:, : len(at)].T
    inside = at >= 0
    used, local = np.unique(flat[at[inside]], return_inverse=True)
    described = model.describe([words[u] for u in used])
    emit = model.emissions(described)
    factors = np.exp(emit - emit.max(axis=1, keepdims=True)) + 1e-30
    trans, start = np.exp(model.p["trans"]), np.exp(model.p["start"])
    grid = np.ones((*at.shape, k))
    grid[inside] = factors[local]
    # What follows a sequence's end is apart from it.
    p, ahead, back = marginals(grid, ~inside, trans, start)
    scale = 1 / inside.sum()
    truth = np.eye(k)[y]
    d = sum_by(local, (p - truth)[inside] * scale, len(used))
    # Pair probabilities of neighbours, for the transitions.
    both = inside[1:]
    pair = ahead[:-1][both][:, :, None] * trans * (grid[1:] * back[1:])[both][:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:-1][both], y[1:][both]), 1)
    grads = model.gradients(described, d)
    grads["trans"] = (pair.sum(axis=0) - seen) * scale
    grads["start"] = (p[0] - truth[0]).sum(axis=0) * scale
    adam.step(grads)


def identify(model: Field | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and its share of the words' label probabilities, for whole texts."""
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    flat, lengths, words = letter_words(texts)
    probabilities = label_words(model, flat, lengths, model.emissions(model.describe(words)))
    sums = segment_sum(probabilities, lengths)
    best = sums.argmax(axis=1) if len(texts) else np.zeros(0, int)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)]
    return names, np.minimum(sums.max(axis=1) / np.maximum(lengths, 1), 1.0)


def fit_langid(
    docs: DataFrame, sample: int = SAMPLE, hold_out: int = HOLD_OUT, folds: int = FOLDS, most_bytes: int = BYTES
) -> Field | None:
    """Learn from text and language of about ``sample`` documents at most outside the fold
    ``hold_out``, one row per id, whose texts have ``most_bytes`` together at most."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != hold_out)
    )
    ids = bounded_sample(known.select("doc_id").distinct(), "doc_id", sample)
    rows = bounded_rows(known.join(ids, "doc_id"), ["text"], most_bytes)
    return train(rows["text"], rows["lang"])


def language_report(docs: DataFrame) -> DataFrame:
    model = fit_langid(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in slices(batches, "text"):
            names, score = identify(model, texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HOLD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def word_languages(model: Field, text: str) -> list[tuple[str, str]]:
    """Each word that has a letter, with its most probable language: for code-switched text."""
    flat, lengths, words = letter_words([text])
    p = label_words(model, flat, lengths, model.emissions(model.describe(words)))
    return [(words[w].decode(), model.languages[b]) for w, b in zip(flat, p.argmax(axis=1), strict=True)]

