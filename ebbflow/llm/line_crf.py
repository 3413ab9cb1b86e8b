"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text that holds a word is labelled good or bad. Its features are
shares of characters and words of the line itself and of the lines before and after;
a transition score links neighbouring labels. Forward-backward marginals of "good",
weighted by line length, average into the score of the document.

Training (numpy, on the driver) uses a bounded sample: ``SAMPLE_PER_CLASS`` labelled
documents of either class, by hash order, and ``SAMPLE_LINES`` lines of each; only line
features leave the executors. A document's label stands for all its lines. Scoring covers
every line of every text inside ``mapInArrow``, without a shuffle.

Defined results: null, empty and blank texts count as one line without characters and are
scored like any other; repeated rows are scored one by one; without labels every score
is 0.5; an empty table gives no rows; further columns pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ebbflow.llm.arrow_text import IS_SPACE, crc32_of_id, flat_bytes, per_row, sliced, text_array, words
from ebbflow.llm.sampling import first_by_hash

#: Labelled documents of each class that the model is fitted on, and lines of each.
SAMPLE_PER_CLASS = 1500
SAMPLE_LINES = 48
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

UPPER = np.isin(np.arange(256), np.arange(65, 91))
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
STOP = np.isin(np.arange(256), list(b".,;:'\"()-?"))
SHOUT = np.isin(np.arange(256), list(b"!"))
PIPE = np.isin(np.arange(256), list(b"|"))
HIGH = np.arange(256) >= 0xC0
N_FEATURES = 14


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line with a word, byte length of the lines, offsets of the texts
    in them); a text without such a line has one row of zeros."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.values
    text_at = np.asarray(lists.offsets, np.int64)
    data, at = flat_bytes(lines)
    flat, word_at = words(lines)
    n_words = np.diff(word_at).astype(float)
    size = np.diff(at).astype(float)
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_of = np.repeat(np.arange(len(lines)), np.diff(word_at))
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (line_of[1:] == line_of[:-1])
    pairs = np.unique(line_of * (len(ids) + 1) + ids) // (len(ids) + 1)
    distinct = np.bincount(pairs, minlength=len(lines))
    text_of = np.repeat(np.arange(len(texts)), np.diff(text_at))
    line_ids = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = text_of * (len(lines) + 1) + line_ids
    _, first = np.unique(key, return_index=True)
    copy = np.ones(len(lines))
    copy[first] = 0
    full = np.maximum(size, 1.0)
    some = np.maximum(n_words, 1.0)
    last = data[np.clip(at[1:] - 1, 0, max(0, len(data) - 1))] if len(data) else np.zeros(len(lines), np.uint8)
    head = data[np.clip(at[:-1], 0, max(0, len(data) - 1))] if len(data) else np.zeros(len(lines), np.uint8)

    def share(table):
        return per_row(table[data], at) / full

    x = np.column_stack([
        np.log1p(size), share(UPPER), share(DIGIT), share(SYMBOL), share(STOP), share(SHOUT), share(PIPE), share(HIGH),
        np.minimum(per_row(~IS_SPACE[data], at) / some, 40.0), per_row(again, word_at) / some, distinct / some,
        copy, np.isin(last, list(b".!?")).astype(float), UPPER[head].astype(float)]).astype(np.float32)
    used = n_words > 0
    blank = np.flatnonzero(per_row(used, text_at) == 0)
    where = np.concatenate([np.flatnonzero(used), np.full(len(blank), -1)])
    owner = np.concatenate([text_of[used], blank])
    order = np.argsort(owner, kind="stable")
    where, owner = where[order], owner[order]
    x = np.where(where[:, None] >= 0, x[where] if len(x) else 0.0, 0.0).astype(np.float32)
    length = np.where(where >= 0, size[where] if len(size) else 0.0, 1.0)
    return x, length, np.searchsorted(owner, np.arange(len(texts) + 1))


def with_neighbours(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of the line, of the one before and of the one after, and flags for none."""
    first = np.zeros(len(x), bool)
    last = np.zeros(len(x), bool)
    first[at[:-1]] = True
    last[at[1:] - 1] = True
    before = np.roll(x, 1, axis=0)
    after = np.roll(x, -1, axis=0)
    before[first] = 0
    after[last] = 0
    return np.column_stack([x, before, after, first, last, np.ones(len(x))]).astype(np.float32)


@dataclass
class Model:
    """``weights`` score the label good against bad; ``steps[i, j]`` scores label j after i."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray

    def emissions(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return with_neighbours(((x - self.mean) / self.scale).astype(np.float32), at) @ self.weights


def padded(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``values`` as (line, document), longest documents first; its order and their lengths."""
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    n = n[order]
    out = np.zeros((n[0], len(n)))
    line = np.arange(len(values)) - np.repeat(at[:-1], np.diff(at))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out[line, np.repeat(place, np.diff(at))] = values
    return out, order, n


def forward_backward(e: np.ndarray, n: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds good : bad of the messages before and after each line, for the padded
    emissions ``e``; documents are sorted by length, so each step works on a prefix."""
    (s00, s01), (s10, s11) = steps
    ahead, back = e.copy(), np.zeros_like(e)
    live = np.searchsorted(-n, -np.arange(1, len(e) + 1), side="right")  # documents with a line t
    for t in range(1, len(e)):
        a = ahead[t - 1, :live[t]]
        ahead[t, :live[t]] += np.logaddexp(s11 + a, s01) - np.logaddexp(s10 + a, s00)
    for t in range(len(e) - 2, -1, -1):
        b = e[t + 1, :live[t + 1]] + back[t + 1, :live[t + 1]]
        back[t, :live[t + 1]] = np.logaddexp(s11 + b, s10) - np.logaddexp(s01 + b, s00)
    return ahead, back


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def train(x: np.ndarray, at: np.ndarray, good: np.ndarray, rounds: int = 250, l2: float = 1e-3, rate: float = 0.05) -> Model:
    """Gradient ascent (Adam) on the conditional log-likelihood of the line labels."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    model = Model(mean, scale, np.zeros(3 * x.shape[1] + 3), np.zeros((2, 2)))
    z = with_neighbours(((x - mean) / scale).astype(np.float32), at)
    n_docs = len(at) - 1
    y = np.repeat(good.astype(float), np.diff(at))
    line = np.arange(len(x)) - np.repeat(at[:-1], np.diff(at))
    _, order, n = padded(np.zeros(len(x)), at)
    place = np.empty(n_docs, np.int64)
    place[order] = np.arange(n_docs)
    column = np.repeat(place, np.diff(at))
    has_next = np.arange(n[0])[:, None] < n[None, :] - 1
    label = good[order].astype(float)
    observed = np.zeros((2, 2))
    observed[1, 1] = (has_next * label).sum()
    observed[0, 0] = (has_next * (1 - label)).sum()
    theta = np.zeros(len(model.weights) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        model.weights, model.steps = theta[:-4], theta[-4:].reshape(2, 2)
        e = np.zeros((n[0], n_docs))
        e[line, column] = z @ model.weights
        ahead, back = forward_backward(e, n, model.steps)
        p = sigmoid(ahead + back)[line, column]
        grad_w = z.T @ (y - p)
        nxt = np.vstack([(e + back)[1:], np.zeros((1, n_docs))])
        joint = np.stack([np.zeros_like(e) + model.steps[0, 0], nxt + model.steps[0, 1],
                          ahead + model.steps[1, 0], ahead + nxt + model.steps[1, 1]])
        joint = np.exp(joint - joint.max(axis=0))
        joint = joint / joint.sum(axis=0) * has_next
        grad = np.concatenate([grad_w, (observed - joint.sum(axis=(1, 2)).reshape(2, 2)).ravel()]) / len(x) - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    model.weights, model.steps = theta[:-4], theta[-4:].reshape(2, 2)
    return model


def document_scores(column, model: Model) -> np.ndarray:
    """Score of every text. Texts of like line counts (within a factor of two) are padded
    together, so memory follows the lines of the batch and not its longest text."""
    texts = text_array(column)
    x, length, at = line_features(texts)
    e = model.emissions(x, at)
    n = np.diff(at)
    out = np.empty(len(texts))
    power = np.frexp(n)[1]
    for k in np.unique(power):
        rows = np.flatnonzero(power == k)
        lines = np.repeat(power, n) == k
        cuts = np.concatenate([[0], np.cumsum(n[rows])])
        padded_e, order, sizes = padded(e[lines], cuts)
        ahead, back = forward_backward(padded_e, sizes, model.steps)
        weight, _, _ = padded(length[lines], cuts)
        out[rows[order]] = (weight * sigmoid(ahead + back)).sum(axis=0) / weight.sum(axis=0)
    return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, lines: int = SAMPLE_LINES) -> Model:
    """Fit on labelled documents whose crc32(doc_id) mod ``FOLDS`` is not ``HELD_OUT``."""
    known = (labels.where("doc_id is not null and quality is not null")
             .where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
             .groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality")))
    sample = first_by_hash(known, "quality", "doc_id", per_class)

    def run(batches):
        for part in sliced(batches):
            x, _, at = line_features(text_array(part.column("text")))
            raw = [x[a:b][(b - a - lines) // 2 if b - a > lines else 0:][:lines].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "quality": part.column("quality"),
                                              "lines": pa.array(raw, pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    # At most 2 * per_class ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = (rows.mapInArrow(run, f"doc_id {kind}, quality long, lines binary")
            .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("lines").alias("lines")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)))
    parts = [np.frombuffer(r["lines"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return train(np.concatenate(parts), at, np.array([r["quality"] == 1 for r in rows]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    def run(batches):
        for part in sliced(batches):
            got = document_scores(part.column("text"), model)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "held_out": pa.array(crc32_of_id(part.column("doc_id")) % FOLDS == HELD_OUT),
                "score": pa.array(got), "predicted": pa.array((got >= threshold).astype(np.int32))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    def run(batches):
        for part in sliced(batches):
            yield part.filter(pa.array(document_scores(part.column("text"), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
