"""Toxic spans by a linear-chain conditional random field.

Labels are of documents, so tokens are labelled first: a feature (a word, or its
first 3, 4, 5 or 6 bytes) marks a token of a toxic training document when it occurs
in too many toxic and too few clean ones for chance.  A two-state chain (clean,
toxic) with weights for features and transitions is then trained on segments of
labelled tokens by maximum likelihood.  For a text, forward and backward messages
give each token's marginal probability of being toxic; the document's score is a
logistic function of the largest marginal and of the expected number of toxic
tokens, fitted on training documents that the chain has not seen.  Tokens above
one half give the offending offsets.

Tokens without any weighted feature only pass messages on, by the same matrix; runs
of them are crossed at once by its power, so the cost follows the tokens that have
a feature and inference stays exact.  All texts of a slice are one chain, which starts
anew with each text and is worked on in blocks side by side, so the length of a text
costs no steps of its own.

The model is fitted on whole texts of a bounded sample of labelled documents: of each
class those with the smallest hash of their id, at most ``MAX_DOCS`` of them, until
their texts reach ``MAX_BYTES``.  The chain is trained on all segments of the sample
with a token labelled toxic and on as many others, drawn at random (``LEAST_CLEAN`` at
least, if there are).  Every text is scored whole.  Labels, language, source and id are no
inputs of a score.

Defined results: a null or empty text has the score of no toxic tokens; a null id
is not held out; without labels of both classes every score is 0; several labels of
one id count as toxic if any is, and of several texts of a labelled id one is fitted on;
repeated rows are scored alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrow
from .words import HashTable, Words, hashes, slices, spread

MAX_DOCS = 3_000
MAX_BYTES = 4 << 20
PREFIXES = (3, 4, 5, 6)
SEGMENT = 32
LEAST_CLEAN = 3_000
#: Segments that a gradient is computed of at a time, which bounds the fit's memory.
CHUNK = 1_024
EPOCHS = 60
LEAST_WEIGHT = 0.15

#: Tokens lie between ASCII bytes that are neither letters nor digits; case of A-Z is ignored.
BREAKS = np.array([not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128) for b in range(256)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    """The tokens of the texts, and the hashes of their features: [token, feature]."""
    words = Words(texts, BREAKS, lower=True)
    found = np.empty((len(words.starts), 1 + len(PREFIXES)), dtype=np.uint64)
    found[:, 0] = hashes(words.data, words.starts, words.ends)
    for k, n in enumerate(PREFIXES, 1):
        part = hashes(words.data, words.starts, np.minimum(words.starts + n, words.ends))
        found[:, k] = part ^ np.uint64(0x9E3779B97F4A7C15 * n & (1 << 64) - 1)
    return words, found


def _odds(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[k] = (b[k] + x[k - 1] * d[k]) / (a[k] + x[k - 1] * c[k]) for all k, from 0 before the first; nothing is negative.

    The chain is cut into blocks, which take each step together: first to the product of
    each block's matrices, from which follows what enters it, then to the values in it.
    """
    n = len(a)
    steps = max(1, int(np.sqrt(n)))
    blocks = -(-n // steps)

    def dealt(x: np.ndarray, rest: float) -> np.ndarray:
        """[step, block]"""
        return np.append(x, np.full(blocks * steps - n, rest)).reshape(blocks, steps).T.copy()

    a, b, c, d = dealt(a, 1.0), dealt(b, 0.0), dealt(c, 0.0), dealt(d, 1.0)
    p, q, r, s = a[0], b[0], c[0], d[0]
    for t in range(1, steps):
        p, q, r, s = p * a[t] + q * c[t], p * b[t] + q * d[t], r * a[t] + s * c[t], r * b[t] + s * d[t]
        if t % 4 == 0:
            size = p + q + r + s
            p, q, r, s = p / size, q / size, r / size, s / size
    enter = [0.0]
    for one in zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True):
        enter.append((one[1] + enter[-1] * one[3]) / (one[0] + enter[-1] * one[2]))
    x = np.array(enter[:-1])
    for t in range(steps):
        x = (b[t] + x * d[t]) / (a[t] + x * c[t])
        a[t] = x
    return a.T.ravel()[:n]


@dataclass
class Model:
    """Weights of the chain and of the document score."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.zeros(3))
    trained: bool = False

    def __post_init__(self) -> None:
        self.table = HashTable()
        if len(self.keys):
            self.table.add(self.keys)

    def emissions(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token has a weighted feature, and its score for toxic against clean."""
        number = self.table.find(found.ravel()).reshape(found.shape)
        return (number >= 0).any(axis=1), np.where(number >= 0, np.append(self.weights, 0.0)[number], 0.0).sum(axis=1) + self.bias

    def marginals(self, found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens with a feature or next to one, and their marginals of being toxic; text i has tokens first[i]:first[i + 1]."""
        has, score = self.emissions(found)
        near = has.copy()
        near[1:] |= has[:-1]
        near[:-1] |= has[1:]
        at = np.flatnonzero(near)
        if not len(at):
            return at, np.zeros(0)
        step = np.exp(self.transitions)
        neutral = step * np.exp(np.array([0.0, self.bias]))
        values, vectors = np.linalg.eig(neutral)
        order = np.argsort(-values.real)
        ratio, vectors = float((values[order[1]] / values[order[0]]).real), vectors[:, order].real
        inverse = np.linalg.inv(vectors)
        lasting, fading = np.outer(vectors[:, 0], inverse[0]), np.outer(vectors[:, 1], inverse[1])  # neutral ** gap is lasting + ratio ** gap * fading

        text = np.searchsorted(first, at, side="right") - 1
        begins = np.append(True, text[1:] != text[:-1])
        ends = np.append(begins[1:], True)
        gap = at - np.where(begins, first[text], np.append(0, at[:-1] + 1))
        left = np.power(ratio, gap)
        own = np.exp(np.clip(score[at], -30, 30))
        x, y = lasting @ step, fading @ step
        m00, m10 = (x[i, 0] + y[i, 0] * left for i in (0, 1))
        m01, m11 = ((x[i, 1] + y[i, 1] * left) * own for i in (0, 1))
        del gap, left, own
        odds = _odds(m00, m01, np.where(begins, 0.0, m10), np.where(begins, 0.0, m11))
        # A message back to an event passes the matrix of the event after it, or the neutral tokens at a text's end.
        tail = np.power(ratio, first[text[ends] + 1] - at[ends] - 1)
        for i, m in enumerate((m00, m10, m01, m11)):
            m[:-1] = m[1:]
            m[ends] = lasting[i].sum() + fading[i].sum() * tail if i < 2 else 0.0
        odds *= _odds(m00[::-1], m10[::-1], m01[::-1], m11[::-1])[::-1]
        return at, odds / (1 + odds)

    def summary(self, at: np.ndarray, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each text: 1, its largest marginal, and the log of one plus its expected toxic tokens (those above one tenth)."""
        out = np.zeros((len(first) - 1, 3))
        out[:, 0] = 1
        strong = p > 0.1
        text = np.searchsorted(first, at[strong], side="right") - 1
        np.maximum.at(out[:, 1], text, p[strong])
        out[:, 2] = np.log1p(np.bincount(text, p[strong], minlength=len(out)))
        return out

    def scores(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.document, -30, 30))) if self.trained else np.zeros(len(summary))


def _token_labels(found: np.ndarray, text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic texts with a feature that is too frequent in toxic texts for chance.

    A feature counts once for each pair of neighbours it is seen between, so copies
    of one text do not make all of its words suspect.
    """
    bad_token = toxic[text].astype(bool)
    share = bad_token.mean()
    word = found[:, 0]
    around = np.roll(word, 1) * np.uint64(0x9E3779B97F4A7C15) ^ np.roll(word, -1)
    out = np.zeros(len(found), dtype=bool)
    for c in range(found.shape[1]):
        key = found[:, c]
        _, once = np.unique(key * np.uint64(0xC2B2AE3D27D4EB4F) ^ around, return_index=True)
        keys, number = np.unique(key, return_inverse=True)
        n = np.bincount(number[once], minlength=len(keys))
        bad = np.bincount(number[once], bad_token[once], minlength=len(keys))
        q = np.clip(bad / np.maximum(n, 1), 1e-9, 1 - 1e-9)
        surprise = bad * np.log(q / share) + (n - bad) * np.log((1 - q) / (1 - share))
        marks = (q > 0.97) & (surprise > np.log(max(2, len(keys))) + 2) & (bad >= 4)
        out |= marks[number]
    return (out & bad_token).astype(np.int64)


def _gradient(w: np.ndarray, bias: float, trans: np.ndarray, number: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple:
    """Expected less observed counts of features, toxic tokens and transitions, of segments (rows) by forward-backward."""
    shape = y.shape
    before = np.concatenate((np.zeros((shape[0], 1), np.int64), y[:, :-1]), axis=1)
    score = w[number].sum(axis=2) + bias
    own = np.stack((np.ones(shape), np.exp(np.clip(score, -30, 30))), axis=2)
    own = np.where(live[..., None] > 0, own, 1.0)
    step = np.exp(trans)
    ahead, back = np.empty((*shape, 2)), np.ones((*shape, 2))
    message = np.tile([1.0, 0.0], (shape[0], 1))
    for t in range(shape[1]):
        m = (message @ step) * own[:, t]
        message = m / m.sum(axis=1, keepdims=True)
        ahead[:, t] = message
    for t in range(shape[1] - 2, -1, -1):
        on = live[:, t + 1, None] > 0
        m = np.where(on, (back[:, t + 1] * own[:, t + 1]) @ step.T, 1.0)
        back[:, t] = m / m.sum(axis=1, keepdims=True)
    both = ahead * back
    error = (both[..., 1] / both.sum(axis=2) - y) * live
    edge = np.zeros((2, 2))
    for t in range(shape[1]):
        left = ahead[:, t - 1] if t else np.tile([1.0, 0.0], (shape[0], 1))
        joint = left[:, :, None] * step[None] * (own[:, t] * back[:, t])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        on = live[:, t] > 0
        edge += joint[on].sum(axis=0)
        np.subtract.at(edge, (before[on, t], y[on, t]), 1)
    return np.bincount(number.ravel(), np.repeat(error.ravel(), number.shape[2]), minlength=len(w)), error.sum(), edge


def _train_chain(found: np.ndarray, first: np.ndarray, labels: np.ndarray, seed: int = 5) -> Model:
    """Maximum likelihood by full-batch Adam over segments of labelled tokens."""
    size = np.diff(first)
    begin = spread(np.zeros(len(size), dtype=np.int64), -(-size // SEGMENT)) * SEGMENT + np.repeat(first[:-1], -(-size // SEGMENT))
    stop = np.minimum(begin + SEGMENT, np.repeat(first[1:], -(-size // SEGMENT)))
    sums = np.concatenate(([0], np.cumsum(labels)))
    marked = sums[stop] > sums[begin]
    clean = np.random.default_rng(seed).permutation(np.flatnonzero(~marked))
    used = np.concatenate((np.flatnonzero(marked), clean[: max(LEAST_CLEAN, int(marked.sum()))]))
    begin, stop = begin[used], stop[used]
    index = np.minimum(begin[:, None] + np.arange(SEGMENT), len(labels) - 1)
    live = (begin[:, None] + np.arange(SEGMENT) < stop[:, None]).astype(float)
    y = labels[index] * live.astype(np.int64)

    keys, counts = np.unique(found[index[live > 0]].ravel(), return_counts=True)
    keys = keys[counts >= 2]
    table = HashTable()
    table.add(keys)
    number = table.find(found[index].ravel()).reshape(*index.shape, found.shape[1]).astype(np.int32)
    number[number < 0] = len(keys)
    w, bias, trans = np.zeros(len(keys) + 1), -3.0, np.zeros((2, 2))
    moments = [[np.zeros_like(w), np.zeros_like(w)], [0.0, 0.0], [np.zeros((2, 2)), np.zeros((2, 2))]]
    parts = [slice(k, k + CHUNK) for k in range(0, len(y), CHUNK)]
    for epoch in range(1, EPOCHS + 1):
        sums = [_gradient(w, bias, trans, number[p], live[p], y[p]) for p in parts]
        grads = [sum(g[0] for g in sums) + 0.5 * w, sum(g[1] for g in sums), sum(g[2] for g in sums) + 0.5 * trans]
        grads[0][-1] = 0
        n, values = live.sum(), [w, bias, trans]
        for k, g in enumerate(grads):
            moments[k][0] = 0.9 * moments[k][0] + 0.1 * g / n
            moments[k][1] = 0.99 * moments[k][1] + 0.01 * (g / n) ** 2
            values[k] = values[k] - 0.15 * (moments[k][0] / (1 - 0.9**epoch)) / (np.sqrt(moments[k][1] / (1 - 0.99**epoch)) + 1e-9 + 1e-7)
        w, bias, trans = values[0], float(values[1]), values[2]
    keep = np.abs(w[:-1]) >= LEAST_WEIGHT
    return Model(keys[keep], w[:-1][keep], bias, trans)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (p - y) + 0.05 * w)
    return w


def fit(texts: list[bytes], toxic: list[int]) -> Model:
    """A model from labelled texts: the chain from two thirds of them, the document score from the rest."""
    toxic = np.array(toxic)
    chain, rest = [k for k in range(len(texts)) if k % 3], [k for k in range(len(texts)) if k % 3 == 0]
    if len(set(toxic[chain])) < 2 or len(set(toxic[rest])) < 2:
        return Model()
    words, found = features([texts[k] for k in chain])
    text = np.repeat(np.arange(len(chain)), np.diff(words.first))
    labels = _token_labels(found, text, toxic[chain].astype(float))
    if not labels.any():
        return Model()
    model = _train_chain(found, words.first, labels)
    words, found = features([texts[k] for k in rest])
    model.document = _logistic(model.summary(*model.marginals(found, words.first), words.first), toxic[rest])
    model.trained = True
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_DOCS, most_bytes: int = MAX_BYTES) -> Model:
    """A model from the documents of ``labels`` (doc_id, toxic) that are not held out.

    Of each class at most ``most`` documents are used, and none once the texts before it
    have reached ``most_bytes``; texts are never cut.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(11))
    picked = [known.filter(F.col("toxic") == k).orderBy(order).limit(most) for k in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]).select(F.col("doc_id").alias("of"), "toxic"))
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).join(picked, F.col("doc_id") == F.col("of"))
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).cast("binary").alias("text"))
    before = Window.partitionBy("toxic").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # at most ``most`` rows
    rows = rows.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))).filter(F.col("before") < most_bytes)
    rows = rows.select("doc_id", "text", "toxic").toPandas().sort_values("doc_id")
    rows = rows.iloc[np.argsort([hash_of(x) for x in rows["doc_id"]], kind="stable")]
    return fit([bytes(t) for t in rows["text"]], rows["toxic"].tolist())


def hash_of(x) -> int:
    import zlib

    return zlib.crc32(f"order {x}".encode())


SPAN = "array<struct<start: int, end: int, p: double>>"


def _scorer(spark, model: Model, texts_of):
    """A function over batches: the first column, score and spans; ``texts_of`` finds the texts in a batch."""
    shared = spark.sparkContext.broadcast((model.keys, model.weights, model.bias, model.transitions, model.document, model.trained))  # at most one weight a feature of the bounded sample
    cache: dict = {}

    def score(batch: pa.RecordBatch) -> dict:
        if not cache:
            cache["model"] = Model(*shared.value)
        own, texts, scores, spans = cache["model"], texts_of(batch), [], []
        for a, b in slices(texts):
            part = texts[a:b]
            words, found = features(part)
            at, p = own.marginals(found, words.first)
            scores.append(own.scores(own.summary(at, p, words.first)))
            lists: list[list] = [[] for _ in part]
            base = np.cumsum([0] + [len(t) + 1 for t in part])
            strong = p > 0.5
            for k, q in zip(at[strong], p[strong], strict=True):
                i = int(np.searchsorted(words.first, k, side="right")) - 1
                lists[i].append((int(words.starts[k] - base[i]), int(words.ends[k] - base[i]), float(q)))
            spans += [_in_code_points(t, x) for t, x in zip(part, lists, strict=True)]
        return {batch.schema.names[0]: batch.column(0), "score": np.concatenate(scores), "spans": spans}

    return score


def tag(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, spans (offsets in code points and marginals of tokens above one half) of each row."""
    score = _scorer(docs.sparkSession, model, lambda batch: arrow.texts(batch.column(1)))
    cols = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return arrow.mapped(cols, score, arrow.with_column("doc_id", docs.schema[doc_id].dataType, f"score double, spans {SPAN}"))


def _in_code_points(text: bytes, spans: list[tuple[int, int, float]]) -> list[dict]:
    out, at, chars = [], 0, 0
    for start, end, p in spans:
        chars += len(text[at:start].decode("utf-8", "replace"))
        size = len(text[start:end].decode("utf-8", "replace"))
        out.append({"start": chars, "end": chars + size, "p": p})
        at, chars = end, chars + size
    return out


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, spans for each row of ``docs``."""
    tagged = tag(docs, train(docs, labels, doc_id, text), doc_id, text)
    return tagged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def keep_clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, without the documents that are predicted toxic."""
    at = docs.columns.index(text)
    score = _scorer(docs.sparkSession, train(docs, labels, doc_id, text), lambda batch: arrow.texts(batch.column(0).field(at)))
    rows = docs.select(F.struct("*").alias("row"))
    return arrow.mapped(rows, score, arrow.with_column("row", rows.schema["row"].dataType, f"score double, spans {SPAN}")).filter(F.col("score") < 0.5).select("row.*")
