"""Language ID: a bidirectional gated recurrent network over bytes.

Texts are cut into segments of ``SEGMENT`` bytes that run side by side, a forward and a
backward network read each, and both states together give every byte position a
distribution over the languages. The mean over all positions of the whole text is the
document's distribution. The network is trained in numpy by backpropagation through time
(Adam) on a bounded sample: ``SAMPLE_PER_LANG`` documents of each language, by hash order,
and ``SAMPLE_SEGMENTS`` segments of each. Prediction runs inside ``mapInArrow``, without a
shuffle, over every byte.

Defined results: ``und`` with score 0 for null texts, texts without letters, and when
nothing could be learned; repeated rows are predicted one by one; documents without lang
are predicted but not learned from; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ebbflow.llm.arrow_text import crc32_of_id, flat_bytes, sliced, text_array
from ebbflow.llm.sampling import first_by_hash

#: Documents of each language that the network is trained on, and segments of each.
SAMPLE_PER_LANG = 300
SAMPLE_SEGMENTS = 4
SEGMENT = 64
HIDDEN = 8
FOLDS, HELD_OUT = 3, 1
PAD = 256
#: Segments that run side by side; keeps the states in the processor's cache.
LANES = 4096


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Per direction: byte table (257, 3H) and recurrent weights (H, 3H), in the order
    update gate, reset gate, candidate; then the label layer."""

    langs: list[str]
    tables: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.recurrent, self.out, self.bias]


def new_network(langs: list[str], hidden: int, seed: int) -> Network:
    rnd = np.random.default_rng(seed)
    make = lambda *shape, s: (rnd.standard_normal(shape) * s).astype(np.float32)
    return Network(langs, [make(257, 3 * hidden, s=0.3) for _ in range(2)],
                   [make(hidden, 3 * hidden, s=hidden ** -0.5) for _ in range(2)],
                   make(2 * hidden, len(langs), s=0.3), np.zeros(len(langs), np.float32))


def run_direction(x: np.ndarray, table: np.ndarray, u: np.ndarray, keep: bool):
    """States (time, lane, H) after each byte of ``x`` (time, lane); padding leaves the state
    alone. With ``keep``, also what the backward pass needs."""
    h_size = len(u)
    h = np.zeros((x.shape[1], h_size), np.float32)
    states = np.empty((*x.shape, h_size), np.float32)
    held = []
    for t in range(len(x)):
        a = table[x[t]]
        b = h @ u
        gates = sigmoid(a[:, :2 * h_size] + b[:, :2 * h_size])
        z, r = gates[:, :h_size], gates[:, h_size:]
        c = np.tanh(a[:, 2 * h_size:] + r * b[:, 2 * h_size:])
        z = z * (x[t] != PAD)[:, None]
        new = h + z * (c - h)
        if keep:
            held.append((h, z, r, c, b[:, 2 * h_size:]))
        h = states[t] = new
    return states, held


def back_direction(x, u, held, d_states, d_table, d_u):
    """Backpropagation through time: adds to the gradients of the table and of ``u``."""
    h_size = len(u)
    d_h = np.zeros_like(held[0][0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, c, bc = held[t]
        d_h = d_h + d_states[t]
        d_c = d_h * z * (1 - c * c)
        d_z = d_h * (c - h) * z * (1 - z)
        d_r = d_c * bc * r * (1 - r)
        d_a = np.concatenate([d_z, d_r, d_c], axis=1)
        d_b = np.concatenate([d_z, d_r, d_c * r], axis=1)
        np.add.at(d_table, x[t], d_a)
        d_u += h.T @ d_b
        d_h = d_h * (1 - z) + d_b @ u.T


def position_probabilities(net: Network, x: np.ndarray, keep: bool = False):
    """(time, lane, language) probabilities for bytes ``x`` (time, lane)."""
    ahead, held_a = run_direction(x, net.tables[0], net.recurrent[0], keep)
    back, held_b = run_direction(x[::-1], net.tables[1], net.recurrent[1], keep)
    back = back[::-1]
    h = len(net.recurrent[0])
    logits = ahead.reshape(-1, h) @ net.out[:h] + back.reshape(-1, h) @ net.out[h:] + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    return p.reshape(*x.shape, -1), (ahead, back, held_a, held_b)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the positions of ``x`` (time, lane) and its gradients."""
    p, (ahead, back, held_a, held_b) = position_probabilities(net, x, keep=True)
    h = len(net.recurrent[0])
    real = x != PAD
    n = max(1, int(real.sum()))
    chosen = np.take_along_axis(p, np.broadcast_to(y[None, :, None], (*x.shape, 1)), axis=2)[:, :, 0]
    loss = float(-(np.log(chosen + 1e-9) * real).sum() / n)
    d = p.copy()
    np.put_along_axis(d, np.broadcast_to(y[None, :, None], (*x.shape, 1)), (chosen - 1)[:, :, None], axis=2)
    d = (d * real[:, :, None] / n).astype(np.float32)
    flat = d.reshape(-1, d.shape[2])
    grads = [np.zeros_like(g) for g in net.parameters()]
    grads[4][:h] = ahead.reshape(-1, h).T @ flat
    grads[4][h:] = back.reshape(-1, h).T @ flat
    grads[5][:] = flat.sum(axis=0)
    back_direction(x, net.recurrent[0], held_a, d @ net.out[:h].T, grads[0], grads[2])
    back_direction(x[::-1], net.recurrent[1], held_b, (d @ net.out[h:].T)[::-1], grads[1], grads[3])
    return loss, grads


def train(segments: np.ndarray, labels: np.ndarray, langs: list[str], hidden: int = HIDDEN, epochs: int = 8,
          batch: int = 256, rate: float = 0.02, seed: int = 7) -> Network:
    """Adam on the sampled segments (rows of bytes, padded with ``PAD``)."""
    net = new_network(langs, hidden, seed)
    rnd = np.random.default_rng(seed)
    m = [np.zeros_like(p) for p in net.parameters()]
    v = [np.zeros_like(p) for p in net.parameters()]
    k, total = 0, epochs * -(-len(segments) // batch)
    for _ in range(epochs):
        order = rnd.permutation(len(segments))
        for s in range(0, len(order), batch):
            rows = order[s:s + batch]
            _, grads = gradients(net, segments[rows].T, labels[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            k += 1
            step = rate * (1 - 0.9 * k / total)
            for p, g, a, b in zip(net.parameters(), grads, m, v):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= step * (a / (1 - 0.9 ** k)) / (np.sqrt(b / (1 - 0.99 ** k)) + 1e-8)
    return net


def cut_segments(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``length`` bytes that cover every text, padded at its end, and their texts."""
    n = -(-np.diff(at) // length)
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    begin = at[owner] + nth * length
    place = begin[:, None] + np.arange(length)
    inside = place < at[owner + 1][:, None]
    rows = np.full(place.shape, PAD, np.int16)
    rows[inside] = data[place[inside]]
    return rows, owner


def pooled(column, net: Network) -> np.ndarray:
    """Mean distribution over the positions of each text; zeros for an empty text."""
    data, at = flat_bytes(text_array(column))
    rows, owner = cut_segments(data, at, SEGMENT)
    total = np.zeros((len(at) - 1, len(net.langs)))
    for s in range(0, len(rows), LANES):
        x = np.ascontiguousarray(rows[s:s + LANES].T)
        p, _ = position_probabilities(net, x)
        np.add.at(total, owner[s:s + LANES], (p * (x != PAD)[:, :, None]).sum(axis=0))
    return total / np.maximum(np.diff(at), 1)[:, None]


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, segments: int = SAMPLE_SEGMENTS) -> Network | None:
    """Train on documents with lang whose crc32(doc_id) mod ``FOLDS`` is not ``HELD_OUT``;
    None without any."""
    known = docs.select("doc_id", "lang", "text").where("lang is not null and length(text) > 0")
    known = known.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % FOLDS != HELD_OUT)
    ids = known.select("lang", "doc_id").where("doc_id is not null").distinct()
    sample = first_by_hash(ids, "lang", "doc_id", per_lang)

    def run(batches):
        for part in sliced(batches):
            data, at = flat_bytes(text_array(part.column("text")))
            raw = []
            for a, b in zip(at[:-1], at[1:]):
                starts = np.linspace(a, max(a, b - SEGMENT), segments).astype(int)
                raw.append(b"".join(data[s:min(b, s + SEGMENT)].tobytes().ljust(SEGMENT, b"\0") for s in starts))
            yield pa.RecordBatch.from_pydict({"lang": part.column("lang"), "doc_id": part.column("doc_id"),
                                              "raw": pa.array(raw, pa.binary())})

    # At most per_lang ids of each language.
    rows = (known.join(F.broadcast(sample), ["lang", "doc_id"]).select("lang", "doc_id", "text")
            .mapInArrow(run, f"lang string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, raw binary")
            .groupBy("lang", "doc_id").agg(F.min("raw").alias("raw")).collect())
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["doc_id"]))
    langs = sorted({r["lang"] for r in rows})
    x = np.concatenate([np.frombuffer(r["raw"], np.uint8).reshape(-1, SEGMENT) for r in rows]).astype(np.int16)
    x[x == 0] = PAD
    return train(x, np.repeat([langs.index(r["lang"]) for r in rows], segments), langs)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    def run(batches):
        for part in sliced(batches, most=4 << 20):
            text = part.column("text")
            letters = np.asarray(pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False))
            if net is None:
                names, score = np.full(len(text), "und", object), np.zeros(len(text))
            else:
                p = pooled(text, net)
                names = np.where(letters, np.array(net.langs, object)[p.argmax(axis=1)], "und")
                score = np.where(letters, np.clip(p.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "held_out": pa.array(crc32_of_id(part.column("doc_id")) % FOLDS == HELD_OUT),
                "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
