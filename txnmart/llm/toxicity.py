"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a learned vector of the word (one for all unknown words) beside the mean of
learned vectors of its hashed character 3-grams. Windows of ``WINDOW`` words, every ``STRIDE``
words and one at the end, cover the whole text and overlap; each is read in both directions,
pooled by attention and given a logit. A document's logit is the mean of its windows' logits
weighted by their softmax, so that the worst passage decides. The label of a document trains
all its windows through the same weighting. In the second half of training, documents that still
contradict their label by more than 0.8 count ``DOUBT``: the label may be wrong, or of a rare kind.

Training takes a bounded sample of labelled documents (``SAMPLE``: about so many of label 0 and of
label 1 at most, one row per id, and ``BYTES`` of text) on the driver, both labels in equal parts, and the share of label 1 among all labels
then corrects the score; scoring is a map over partitions with the fitted weights, and nothing is shuffled.

NULL and empty texts tell nothing: their score is the share of label 1 among the labels. With no label, or one class only, the score is
that class's share for every document (0 without labels). A NULL id is neither held out nor learned
from. Repeated rows each give a row; extra columns, clashing names included, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import bounded_rows, bounded_sample, fold, one_label, slices
from txnmart.llm.wordtables import EDGE, Adam, ngrams, segment_sum, sum_by, word_numbers

WINDOW, STRIDE = 32, 16
SAMPLE = (2400, 800)
BYTES = 64_000_000  # of texts to learn from
SLICE = 1_000_000  # bytes of texts scored together
WORDS = 4096  # described together
THRESHOLD = 0.3
HOLD_OUT, FOLDS = 2, 4
BUCKETS = 4096
SHARP = 4.0
DOUBT = 0.5  # weight of documents that contradict their label by more than 0.8


def windows(flat: np.ndarray, lengths: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows, and the windows per text (one at least)."""
    n = np.maximum(1, -(-np.maximum(lengths - WINDOW, 0) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    # The last window ends with its text.
    start = np.minimum(nth * STRIDE, np.maximum(lengths[owner] - WINDOW, 0))
    first = (np.cumsum(lengths) - lengths)[owner]
    padded = np.append(flat, pad).astype(np.int32)
    out = np.empty((len(owner), WINDOW), np.int32)
    for k in range(WINDOW):
        at = start + k
        out[:, k] = padded[np.where(at < lengths[owner], first + at, len(flat))]
    return out, n


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights and passes. ``vocabulary`` numbers known words from 1; 0 is any other."""

    def __init__(self, vocabulary: dict[bytes, int], hidden: int = 8, seed: int = 5, dtype=np.float32):
        rng = np.random.default_rng(seed)
        h, e, a = hidden, 8, 8
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(dtype)
        self.vocabulary, self.hidden = vocabulary, hidden
        self.prior = 0.0  # log-odds of label 1 in the corpus, against equal parts
        self.p = {
            "word": draw(0.1, len(vocabulary) + 1, e),
            "char": draw(0.3, BUCKETS, e),
            "wx": draw((2 * e) ** -0.5, 2 * e, 6 * h),
            "bx": np.zeros(6 * h, dtype),
            "uz": draw(h**-0.5, 2, h, 2 * h),
            "un": draw(h**-0.5, 2, h, h),
            "wa": draw((2 * h) ** -0.5, 2 * h, a),
            "va": draw(a**-0.5, a),
            "wo": draw((2 * h) ** -0.5, 2 * h),
            "bo": np.zeros(1, dtype),
        }

    def inputs(self, words: list[bytes]):
        """The network's input of each word, then of the padding: (values, what made them)."""
        bare = [w.strip(EDGE) for w in words]
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in bare), np.int64, len(bare))
        grams, counts = ngrams(bare, (3,), BUCKETS)
        mean = segment_sum(self.p["char"][grams], counts) / np.maximum(counts, 1)[:, None]
        x = np.concatenate([self.p["word"][ids], mean.astype(self.p["word"].dtype)], axis=1)
        x = np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])
        return x, (ids, grams, counts)

    def forward(self, table: np.ndarray, idx: np.ndarray, keep: bool = False):
        """Logits of windows ``idx`` (windows, WINDOW) over the projected inputs ``table``
        (words, both directions, gates)."""
        p, h = self.p, self.hidden
        b, t = idx.shape
        ahead, back = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1])
        state = np.zeros((2, b, h), table.dtype)
        states = np.empty((t, 2, b, h), table.dtype)
        x = np.empty((2, b, 3 * h), table.dtype)
        steps = []
        for k in range(t):
            np.take(ahead, idx[:, k], axis=0, out=x[0])
            np.take(back, idx[:, t - 1 - k], axis=0, out=x[1])
            zr = _sigmoid(x[..., : 2 * h] + state @ p["uz"])
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(x[..., 2 * h :] + (r * state) @ p["un"])
            if keep:
                steps.append((state, z, r, new))
            state = new + z * (state - new)
            states[k] = state
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        u = np.tanh(both @ p["wa"])
        e = u @ p["va"]
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", a, both)
        logits = pooled @ p["wo"] + p["bo"]
        return logits, (steps, both, u, a, pooled) if keep else None

    def backward(self, idx: np.ndarray, cache, d: np.ndarray, words: int):
        """Gradients for logits' gradients ``d``: of the parameters above the inputs, and of the
        projected inputs ``table``."""
        p, h = self.p, self.hidden
        steps, both, u, a, pooled = cache
        t = len(steps)
        g = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
        dpool = d[:, None] * p["wo"]
        da = np.einsum("bh,tbh->tb", dpool, both)
        de = a * (da - (a * da).sum(axis=0))
        du = de[..., None] * p["va"] * (1 - u * u)
        g["va"] = np.einsum("tb,tba->a", de, u)
        g["wa"] = np.einsum("tbh,tba->ha", both, du)
        dboth = a[..., None] * dpool + du @ p["wa"].T
        dstates = np.stack([dboth[..., :h], dboth[::-1, :, h:]], axis=1)
        g["uz"], g["un"] = np.zeros_like(p["uz"]), np.zeros_like(p["un"])
        dtable = np.zeros((words, 2, 3 * h), both.dtype)
        dxs = np.empty((t, 2, len(d), 3 * h), both.dtype)
        carry = np.zeros_like(dstates[0])
        for k in range(t - 1, -1, -1):
            state, z, r, new = steps[k]
            dh = dstates[k] + carry
            dnew = dh * (1 - z) * (1 - new * new)
            drs = dnew @ p["un"].transpose(0, 2, 1)
            dz = dh * (state - new) * z * (1 - z)
            dr = drs * state * r * (1 - r)
            dzr = np.concatenate([dz, dr], axis=2)
            g["un"] += (r * state).transpose(0, 2, 1) @ dnew
            g["uz"] += state.transpose(0, 2, 1) @ dzr
            carry = dh * z + drs * r + dzr @ p["uz"].transpose(0, 2, 1)
            dxs[k] = np.concatenate([dzr, dnew], axis=2)
        for side, order in ((0, idx), (1, idx[:, ::-1])):
            dtable[:, side] = sum_by(order.T.ravel(), dxs[:, side].reshape(-1, 3 * h), words)
        return g, dtable

    def table(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.p["wx"] + self.p["bx"]).reshape(len(x), 2, 3 * self.hidden)

    def input_gradients(self, x, made, dtable) -> dict[str, np.ndarray]:
        ids, grams, counts = made
        flat = dtable.reshape(len(x), -1)
        dx = (flat @ self.p["wx"].T)[:-1]  # the padding's input is fixed
        e = self.p["word"].shape[1]
        per_gram = np.repeat(dx[:, e:] / np.maximum(counts, 1)[:, None], counts, axis=0)
        return {
            "wx": x.T @ flat,
            "bx": flat.sum(axis=0),
            "word": sum_by(ids, dx[:, :e], len(self.p["word"])),
            "char": sum_by(grams, per_gram, BUCKETS),
        }


def pool(logits: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's logit from its windows', and the windows' weights."""
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    w = np.exp(SHARP * (logits - np.maximum.reduceat(logits, first)[owner]))
    w /= np.add.reduceat(w, first)[owner]
    return np.add.reduceat(w * logits, first), w


def tell(bad: np.ndarray, good: np.ndarray, toxic: np.ndarray, least: float = 2.5) -> np.ndarray:
    """How surely a word tells the labels apart: the log-odds of its documents among both labels,
    smoothed, in standard deviations; 0 below ``least``. Only such words get a vector of their
    own, so that chance words of wrongly labelled documents cannot be learned by heart."""
    odds = np.log((bad + 0.5) / ((toxic == 1).sum() - bad + 0.5)) - np.log(
        (good + 0.5) / ((toxic == 0).sum() - good + 0.5)
    )
    z = odds / np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
    return np.where(np.abs(z) >= least, np.clip(z, -8, 8), 0.0)


def _balanced(toxic: np.ndarray, batch: int, steps: int, rng) -> np.ndarray:
    """Rows of each step's documents: half of each label, all of a label before any comes again."""
    halves = []
    for label in (0, 1):
        rows = np.flatnonzero(toxic == label)
        need = steps * (batch // 2)
        rounds = [rng.permutation(rows) for _ in range(-(-need // len(rows)))]
        halves.append(np.concatenate(rounds)[:need].reshape(steps, -1))
    return np.concatenate(halves, axis=1)


def train(
    texts: list[str], toxic: np.ndarray, steps: int = 300, batch: int = 24, rate: float = 0.01, seed: int = 5
) -> Network:
    """Fit the network to documents with labels 0 and 1, both present."""
    flat, lengths, words = word_numbers(texts)
    owner = np.repeat(np.arange(len(texts)), lengths)
    bare = [w.strip(EDGE) for w in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(bare))}
    names = list(number)
    as_bare = np.fromiter((number[w] for w in bare), np.int64, len(bare))
    pairs = np.unique(owner * max(len(names), 1) + as_bare[flat])
    doc, word = pairs // max(len(names), 1), pairs % max(len(names), 1)
    bad = np.bincount(word[toxic[doc] == 1], minlength=len(names))
    told = tell(bad, np.bincount(word, minlength=len(names)) - bad, toxic)
    known = {w: i for i, w in enumerate((names[i] for i in np.flatnonzero(told)), 1)}
    net = Network(known, seed=seed)
    net.p["word"][1:, 0] = 0.25 * told[told != 0]
    adam = Adam(net.p, rate)
    rng = np.random.default_rng(seed)
    first = np.cumsum(lengths) - lengths
    for step, docs in enumerate(_balanced(toxic, batch, steps, rng)):
        adam.rate = rate * (1 - step / steps)
        part = np.concatenate([flat[first[d] : first[d] + lengths[d]] for d in docs])
        used, local = np.unique(part, return_inverse=True)
        idx, counts = windows(local, lengths[docs], len(used))
        x, made = net.inputs([words[u] for u in used])
        logits, cache = net.forward(net.table(x), idx, keep=True)
        doc, weight = pool(logits, counts)
        d = (_sigmoid(doc) - toxic[docs]) / len(docs)
        if 2 * step >= steps:  # a wrong label, or a rare kind that is not learned yet
            d[np.abs(d) * len(docs) > 0.8] *= DOUBT
        of = np.repeat(np.arange(len(docs)), counts)
        d_logits = (d[of] * weight * (1 + SHARP * (logits - doc[of]))).astype(np.float32)
        grads, dtable = net.backward(idx, cache, d_logits, len(x))
        grads |= net.input_gradients(x, made, dtable)
        grads["char"] += 1e-3 * net.p["char"]
        adam.step(grads)
    return net


def score_texts(net: Network, texts: list[str], block: int = 1024) -> np.ndarray:
    """The probability of label 1 of whole texts."""
    flat, lengths, words = word_numbers(texts)
    # Some words at a time, the padding last: describing a word takes a hundred times its size.
    parts = [net.table(net.inputs(words[i : i + WORDS])[0][:-1]) for i in range(0, len(words), WORDS)]
    table = np.concatenate([*parts, net.table(net.inputs([])[0])])
    idx, counts = windows(flat, lengths, len(words))
    logits = np.concatenate([net.forward(table, idx[i : i + block])[0] for i in range(0, len(idx), block)])
    # A text without words tells nothing: the share of label 1.
    return _sigmoid(np.where(lengths > 0, pool(logits.astype(float), counts)[0], 0.0) + net.prior)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample: tuple[int, int] = SAMPLE,
    hold_out: int = HOLD_OUT,
    folds: int = FOLDS,
    most_bytes: int = BYTES,
) -> Network | float:
    """The network, or a constant score where the labels have one class or none. Learns from
    labelled documents outside the fold ``hold_out``, about ``sample`` of each label at most, one row
    per id, whose texts have ``most_bytes`` together at most."""
    known = one_label(labels, "toxic").where(fold(F.col("doc_id"), folds) != hold_out)
    picked = [bounded_sample(known.where(F.col("toxic") == c), "doc_id", sample[c]) for c in (0, 1)]
    texts = docs.select("doc_id", "text").join(picked[0].unionByName(picked[1]), "doc_id")
    rows = bounded_rows(texts, ["text"], most_bytes)
    toxic = np.array(rows["toxic"], float)
    if len(set(toxic)) < 2:
        return float(toxic.mean()) if len(toxic) else 0.0
    net = train([t or "" for t in rows["text"]], toxic)
    share = known.agg(F.avg("toxic")).first()[0]
    net.prior = float(np.log(share / (1 - share)))
    return net


def scorer(net: Network | float):
    """A function of a text column: the score. Texts alone go to Python, and numbers come back."""

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [
                score_texts(net, texts) if isinstance(net, Network) else np.full(len(texts), net)
                for _, texts in slices([batch], "text", SLICE)
            ]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return score


def score_documents(docs: DataFrame, net: Network | float, column: str = "score") -> DataFrame:
    """``docs`` with ``column``; all others stay, and one of that name is replaced."""
    return docs.withColumn(column, scorer(net)("text"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return docs.where(scorer(fit_toxicity(docs, labels))("text") < threshold)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    net = fit_toxicity(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), net)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HOLD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
