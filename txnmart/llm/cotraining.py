"""Quality classifier by co-training on two views of a page.

The content view sees the words of the text (hashed, with shares of repeated, capital and marked
words); the metadata view sees what a crawler records: source, language, length and layout,
numbers cut into bins at quantiles. Each is a logistic model, calibrated on labelled documents that
neither has learned from. In every round each view scores all documents without a label, and of those
it is surest of, in the proportion of the classes, ``PICKS`` go to the other view, which learns from
them; a view that tells nothing of the documents it is calibrated on is sure of none. In the end the
mean of both calibrated log-odds scores every document.

Both views of every document are written once; each round is a map over what was written and a
distributed choice of the first few, so any document can be picked, however many there are. Documents
that both views score alike count as one then, so that copies don't fill the picks. The driver holds
``LABELLED`` labelled documents at most, about, and the picks, one row per id, and ``BYTES`` of
features together.

NULL or empty texts have no words and score by their metadata; NULL metadata is a value of its own.
With no label, or one class only, the score is that class's share (1 without labels). Repeated rows
each give a row; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import bounded_rows, bounded_sample, fold, one_label, slices
from txnmart.llm.wordtables import Adam, segment_sum, word_numbers
from txnmart.scratch import staged, temporary

LABELLED = 3000
PICKS = 200  # documents that a view labels for the other in a round
ROUNDS, SURE = 4, 0.9
BYTES = 128_000_000  # of features that the driver holds
WORDS, NAMES, BINS, DENSE = 1 << 14, 64, 12, 4
HOLD_OUT, FOLDS = 3, 4
KEEP = 0.4
_MARKS = re.compile(r"[#*$%&|<>!]")
META = ["lang", "source", "n_chars"]


@dataclass
class Sparse:
    """Rows of weighted features laid end to end."""

    index: np.ndarray
    value: np.ndarray
    counts: np.ndarray

    def take(self, rows: np.ndarray) -> Sparse:
        first = (np.cumsum(self.counts) - self.counts)[rows]
        n = self.counts[rows]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Sparse(self.index[at], self.value[at], n)


def content_view(texts: list[str]) -> Sparse:
    """Hashed words by 1 + log of their number, each text's scaled to length 1, and four shares:
    words like the one before, words in capitals, words with a mark, distinct words."""
    flat, lengths, words = word_numbers(texts, lower=False)
    bucket = np.fromiter((zlib.crc32(w) % WORDS for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(texts)), lengths)
    key, times = np.unique(owner * WORDS + bucket[flat], return_counts=True)
    row, index = key // WORDS, key % WORDS
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    value = value / norm[row]
    capital = np.fromiter((w.isupper() for w in words), bool, len(words))
    marked = np.fromiter((bool(_MARKS.search(w.decode())) for w in words), bool, len(words))
    same = np.zeros(len(flat), bool)
    same[1:] = (flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])
    n = np.maximum(lengths, 1)
    number = max(len(words), 1)
    distinct = np.bincount(np.unique(owner * number + flat) // number, minlength=len(texts))
    shares = [
        np.bincount(owner, what, minlength=len(texts)) / n for what in (same, capital[flat], marked[flat])
    ] + [distinct / n]
    rows = np.concatenate([row, np.tile(np.arange(len(texts)), DENSE)])
    order = np.argsort(rows, kind="stable")
    index = np.concatenate([index, np.repeat(WORDS + np.arange(DENSE), len(texts))])[order]
    value = np.concatenate([value, *[2 * s for s in shares]])[order]
    return Sparse(index, value, np.bincount(rows, minlength=len(texts)))


def layout(texts: list[str], n_chars: list) -> np.ndarray:
    """Numbers of a page: recorded length, lines, length of lines, share of marks, blank lines."""
    out = np.zeros((len(texts), 5))
    for i, (text, chars) in enumerate(zip(texts, n_chars, strict=True)):
        lines = text.split("\n")
        out[i] = (
            -1 if chars is None else np.log1p(max(chars, 0)),
            np.log1p(len(lines)),
            np.log1p(len(text) / len(lines)),
            len(_MARKS.findall(text)) / max(len(text), 1),
            sum(not x.strip() for x in lines) / len(lines),
        )
    return out


def metadata_view(numbers: np.ndarray, langs: list, sources: list, edges: list[np.ndarray]) -> Sparse:
    """One feature per number's bin, and the hashed names of language and source."""
    n = len(numbers)
    columns = [i * BINS + np.searchsorted(e, numbers[:, i], side="right") for i, e in enumerate(edges)]
    base = len(edges) * BINS
    for k, names in enumerate((langs, sources)):
        columns.append(
            base + k * NAMES + np.array([zlib.crc32(repr(x).encode()) % NAMES for x in names], np.int64)
        )
    index = np.stack(columns, axis=1).ravel() if n else np.zeros(0, np.int64)
    return Sparse(index, np.ones(len(index)), np.full(n, len(columns)))


class Logistic:
    """A logistic model over sparse rows, fitted by Adam over all rows."""

    def __init__(self, size: int):
        self.p = {"w": np.zeros(size), "b": np.zeros(1)}

    def logits(self, x: Sparse) -> np.ndarray:
        return segment_sum(self.p["w"][x.index] * x.value, x.counts) + self.p["b"]

    def fit(self, x: Sparse, y: np.ndarray, steps: int = 80) -> Logistic:
        adam = Adam(self.p, 0.1)
        for _ in range(steps):
            g = (1 / (1 + np.exp(-self.logits(x))) - y) / len(y)
            w = np.bincount(x.index, np.repeat(g, x.counts) * x.value, minlength=len(self.p["w"]))
            adam.step({"w": w + 1e-5 * self.p["w"], "b": g.sum(keepdims=True)})
        return self


def platt(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logits probabilities, with smoothed targets."""
    p, n = y.sum(), (1 - y).sum()
    if not p or not n:
        return 1.0, 0.0
    target = np.where(y == 1, (p + 1) / (p + 2), 1 / (n + 2))
    params = {"a": np.ones(1), "b": np.zeros(1)}
    adam = Adam(params, 0.05)
    for _ in range(400):
        g = (1 / (1 + np.exp(-(params["a"] * logits + params["b"]))) - target) / len(y)
        adam.step({"a": (g * logits).sum(keepdims=True), "b": g.sum(keepdims=True)})
    return float(max(params["a"][0], 1e-3)), float(params["b"][0])


@dataclass
class CoTrained:
    edges: list[np.ndarray]
    models: tuple[Logistic, Logistic]
    scales: list[tuple[float, float]]

    def score(self, views: Views) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of label 1 by content, by metadata, and by both."""
        z = [
            a * m.logits(x) + b
            for m, x, (a, b) in zip(self.models, views.sparse(self.edges), self.scales, strict=True)
        ]
        z.append((z[0] + z[1]) / 2)
        return tuple(_chance(v) for v in z)


def _chance(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


@dataclass
class Views:
    """Both views of some documents, before their numbers are cut into bins."""

    content: Sparse
    numbers: np.ndarray
    langs: list
    sources: list

    @staticmethod
    def of(texts: list[str], langs: list, sources: list, n_chars: list) -> Views:
        return Views(content_view(texts), layout(texts, n_chars), langs, sources)

    @staticmethod
    def read(rows: dict[str, list]) -> Views:
        """What :func:`written_views` holds."""
        index = [np.frombuffer(b, "<u2") for b in rows["words"]]
        value = [np.frombuffer(b, "<f4") for b in rows["weights"]]
        flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        content = Sparse(
            flat(index, np.int64), flat(value, np.float64), np.array([len(i) for i in index], np.int64)
        )
        numbers = flat([np.frombuffer(b, "<f8") for b in rows["numbers"]], np.float64).reshape(-1, 5)
        return Views(content, numbers, rows["lang"], rows["source"])

    def sparse(self, edges: list[np.ndarray]) -> tuple[Sparse, Sparse]:
        return self.content, metadata_view(self.numbers, self.langs, self.sources, edges)


VIEWS = ["words", "weights", "numbers", "lang", "source"]


def written_views(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id`` and both views of every row of ``docs``, as bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in slices(batches, "text"):
            views = Views.of(texts, *[part.column(c).to_pylist() for c in META])
            ends = np.cumsum(views.content.counts)
            cut = lambda flat, kind, ends=ends: [
                flat[a:b].astype(kind).tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("doc_id"),
                    pa.array(cut(views.content.index, "<u2"), pa.binary()),
                    pa.array(cut(views.content.value, "<f4"), pa.binary()),
                    pa.array([n.astype("<f8").tobytes() for n in views.numbers], pa.binary()),
                    part.column("lang"),
                    part.column("source"),
                ],
                names=["row", "doc_id", *VIEWS],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", *META)
    return staged(
        numbered.mapInArrow(
            run,
            f"row long, doc_id {kind}, words binary, weights binary, numbers binary, lang string, source string",
        ),
        "page-views",
    )


def _mapped(views: DataFrame, score, names: list[str]) -> DataFrame:
    """``row``, ``doc_id`` and what ``score`` makes of the views of each document."""
    kind = views.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = score(Views.read({c: batch.column(c).to_pylist() for c in VIEWS}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *[pa.array(f, pa.float64()) for f in found]],
                names=["row", "doc_id", *names],
            )

    schema = ", ".join(f"{n} double" for n in names)
    return views.mapInArrow(run, f"row long, doc_id {kind}, {schema}")


def _surest(scored: DataFrame, of: str, rate: float, picks: int, sure: float) -> list[tuple[int, float]]:
    """(row, label) of the documents that the view ``of`` is surest of, in the proportion of the
    classes; ties by a hash of the scores."""
    out: dict[int, float] = {}
    for label, confidence, part in ((1.0, F.col(of), rate), (0.0, 1 - F.col(of), 1 - rate)):
        best = (
            scored.where(confidence >= sure)
            .orderBy(confidence.desc(), F.xxhash64("content", "metadata"), "row")
            .limit(max(1, int(picks * part)))
        )
        for r in best.select("row").collect():
            out.setdefault(r["row"], label)
    return list(out.items())


def co_train(
    views: DataFrame,
    truth: DataFrame,
    known: dict[str, list],
    rounds: int = ROUNDS,
    picks: int = PICKS,
    sure: float = SURE,
) -> CoTrained:
    """``views``: both views of all documents; ``truth``: the ids (``doc_id``) that have a label;
    ``known``: the views of labelled documents, with ``good`` (0 or 1) and ``calibrate`` (rows kept
    for calibration)."""
    base = Views.read(known)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in base.numbers.T]
    out = CoTrained(edges, (Logistic(WORDS + DENSE), Logistic(base.numbers.shape[1] * BINS + 2 * NAMES)), [])
    own = base.sparse(edges)
    y, hold = np.array(known["good"], float), np.array(known["calibrate"], bool)
    learn = np.flatnonzero(~hold)
    rate = y[learn].mean()
    # The pseudo-labels each view has got from the other: row and label.
    given: list[dict[int, float]] = [{}, {}]
    test = np.flatnonzero(hold) if hold.any() else learn
    for round_ in range(rounds + 1):
        rows = sorted(given[0].keys() | given[1].keys())
        taken = views.where(F.col("row").isin(rows)) if rows else views.limit(0)
        more = taken.select("row", *VIEWS).orderBy("row").toPandas()
        at = {r: i for i, r in enumerate(more["row"].tolist())}
        free = Views.read({c: [None if v != v else v for v in more[c]] for c in VIEWS}).sparse(edges)
        for v in (0, 1):
            use = np.fromiter((at[r] for r in given[v]), np.int64, len(given[v]))
            x, extra = own[v].take(learn), free[v].take(use)
            joined = Sparse(*[np.concatenate(p) for p in zip(
                (x.index, x.value, x.counts), (extra.index, extra.value, extra.counts), strict=True)])
            out.models[v].fit(joined, np.concatenate([y[learn], list(given[v].values())]))
        # How sure a view may be is told by documents it has not learned from.
        out.scales = [platt(out.models[v].logits(own[v].take(test)), y[test]) for v in (0, 1)]
        if round_ == rounds:
            break
        with temporary(views.sparkSession):
            chances = _mapped(views, lambda x: out.score(x)[:2], ["content", "metadata"])
            scored = chances.join(truth.select("doc_id"), "doc_id", "left_anti")
            # Documents that look alike to both views count once.
            once = staged(scored.groupBy("content", "metadata").agg(F.min("row").alias("row")), "page-scores")
            for v, name in enumerate(("content", "metadata")):
                other = once.where(~F.col("row").isin(list(given[1 - v]))) if given[1 - v] else once
                given[1 - v] |= dict(_surest(other, name, rate, picks, sure))
    return out


def fit_quality(
    views: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, most_bytes: int = BYTES
) -> CoTrained | float:
    truth = staged(one_label(labels, label).select("doc_id", F.col(label).alias("good")), "page-labels")
    bound = bounded_sample(truth, "doc_id", labelled).withColumn(
        "calibrate", fold(F.col("doc_id"), FOLDS) == HOLD_OUT
    )
    known = bounded_rows(views.drop("row").join(bound, "doc_id"), ["words", "weights"], most_bytes)
    good = np.array(known["good"], float)
    if len(set(good[~np.array(known["calibrate"], bool)])) < 2:
        return float(good.mean()) if len(good) else 1.0
    return co_train(views, truth, known)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, both views' probabilities, the combined ``score`` and ``kept``."""
    views = written_views(docs)
    model = fit_quality(views, labels)

    def score(some: Views) -> tuple[np.ndarray, ...]:
        if isinstance(model, CoTrained):
            return model.score(some)
        return (np.full(len(some.numbers), model),) * 3

    scored = _mapped(views, score, ["content_score", "metadata_score", "score"]).drop("row")
    return scored.withColumns(
        {"predicted": (F.col("score") >= 0.5).cast("int"), "kept": F.col("score") >= KEEP}
    )
