"""Packing: non-negative least squares over a histogram of lengths.

Every document's ids are cut into full windows and a rest shorter than the window.
For the rests, all combinations of two or three lengths that exactly fill a window are
enumerated, and repeat counts x >= 0 minimise |A x - histogram|^2. An active-set solver
ends on the optimality conditions with at most one positive count for each length, so
rounding keeps nearly all of them. The counts are rounded, largest first, within what the
histogram still holds. What remains is packed greedily: rests laid end to end, longest first,
into open windows and cut where a window ends. Only the last window is padded.

The driver sees the histogram (one number per length below the window) and the plan
(a few thousand patterns), whatever the table's size. A task ranks its rests by length
as it writes the ids; the ranks of a partition are shifted by the counts of the earlier
partitions, so no length, however common, meets in one task.

Defined results: a null text is empty and has the end id alone; repeated rows are
packed as separate documents; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.llm.arrow_text import sliced, text_array
from ebbflow.llm.store import write_once
from ebbflow.llm.tokens import SLICE_BYTES, shared_encoder, tokenizer_path

#: Combinations that enter the active set together at most.
TOGETHER = 128
#: A combination's gradient below this share of the largest count is zero.
ZERO = 1e-9


def combinations_filling(window: int, present: np.ndarray) -> np.ndarray:
    """Pairs and triples of present lengths that sum to ``window``; unused places are 0."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.column_stack([np.zeros_like(a), a, window - a])
    x, y = np.meshgrid(np.arange(1, window), np.arange(1, window), indexing="ij")
    z = window - x - y
    fit = (x <= y) & (y <= z)
    rows = np.concatenate([pairs, np.column_stack([x[fit], y[fit], z[fit]])])
    known = present.copy()
    known[0] = True
    return rows[known[rows].all(axis=1)]


def nnls(rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |A x - target|^2, where column c of A counts the lengths of
    ``rows[c]`` (place 0 is no length).

    Active set: the combinations with the steepest gradients that share no length join the
    set, the least squares problem on the set is solved, and combinations that come out
    without a positive count leave it. While that lowers the residual several join at once;
    in the end one at a time, with steps that stay feasible, until no gradient is positive."""
    n = len(target)
    used = np.where(rows > 0, 1.0, 0.0)
    target = np.where(np.arange(n) > 0, target, 0.0)

    def columns(chosen: np.ndarray) -> np.ndarray:
        a = np.zeros((n, len(chosen)))
        for place in range(rows.shape[1]):
            np.add.at(a, (rows[chosen, place], np.arange(len(chosen))), used[chosen, place])
        return a

    def solved(chosen: np.ndarray) -> np.ndarray:
        a = columns(chosen)
        return np.linalg.solve(a.T @ a + 1e-10 * np.eye(len(chosen)), a.T @ target)

    chosen, x, rest, together = np.zeros(0, np.int64), np.zeros(0), target, TOGETHER
    while together and len(rows):
        gradient = (rest[rows] * used).sum(axis=1)
        gradient[chosen] = -np.inf
        free, new = np.ones(n, bool), []
        steep = np.flatnonzero(gradient > ZERO * target.max())
        for c in steep[np.argsort(-gradient[steep], kind="stable")]:
            lengths = rows[c][rows[c] > 0]
            if free[lengths].all():
                free[lengths] = False
                new.append(c)
                if len(new) == together:
                    break
        if not new:
            break
        trial, y = np.concatenate([chosen, new]).astype(np.int64), np.concatenate([x, np.zeros(len(new))])
        while True:
            z = solved(trial)
            bad = z <= 0
            if not bad.any():
                y = z
                break
            if together == 1:  # as far as the first count that reaches zero
                y = y + np.min(y[bad] / np.maximum(y[bad] - z[bad], 1e-300)) * (z - y)
                bad &= y <= 1e-12
            trial, y = trial[~bad], y[~bad]
        left = target - columns(trial) @ y
        if np.linalg.norm(left) < np.linalg.norm(rest) * (1 - 1e-12):
            chosen, x, rest = trial, y, left
        else:
            together = together // 4 or int(together > 1)
    out = np.zeros(len(rows))
    out[chosen] = x
    return out


@dataclass
class Plan:
    """Where the k-th rest of each length goes. Entries are ordered by length and rank."""

    window: int
    entry_at: np.ndarray      # first entry of each length
    first_rank: np.ndarray    # of each entry
    first_sequence: np.ndarray
    offset: np.ndarray
    planned: np.ndarray       # rests of each length that patterns hold
    left_start: np.ndarray    # first token of each length among the remaining rests
    n_pattern: int            # windows of patterns
    n_left: int               # windows of the remaining rests

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of each piece of a rest."""
        if rank < self.planned[length]:
            a, b = self.entry_at[length], self.entry_at[length + 1]
            e = a + int(np.searchsorted(self.first_rank[a:b], rank, side="right")) - 1
            return [(0, length, int(self.first_sequence[e] + rank - self.first_rank[e]), int(self.offset[e]))]
        at = int(self.left_start[length]) + (rank - int(self.planned[length])) * length
        pieces, done = [], 0
        while done < length:
            offset = (at + done) % self.window
            n = min(length - done, self.window - offset)
            pieces.append((done, n, self.n_pattern + (at + done) // self.window, offset))
            done += n
        return pieces


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """``histogram[L]`` rests have L ids, 0 < L < window."""
    rows = combinations_filling(window, histogram > 0)
    x = nnls(rows, histogram.astype(float))
    free = histogram.astype(np.int64).copy()
    entries: list[tuple[int, int, int, int, int]] = []
    planned = np.zeros(window + 1, np.int64)
    n_pattern = 0
    for c in np.argsort(-x, kind="stable"):
        want = int(np.rint(x[c]))
        if want <= 0:
            break
        lengths = [int(v) for v in rows[c] if v]
        repeats = min([want] + [int(free[v]) // lengths.count(v) for v in lengths])
        if repeats <= 0:
            continue
        offset = 0
        for v in lengths:
            entries.append((v, int(planned[v]), n_pattern, offset, repeats))
            planned[v] += repeats
            free[v] -= repeats
            offset += v
        n_pattern += repeats
    entries.sort()
    table = np.array(entries, np.int64).reshape(-1, 5)
    sizes = np.arange(window) * free
    after = np.concatenate([np.cumsum(sizes[::-1])[::-1][1:], [0]])  # longest first
    return Plan(window, np.searchsorted(table[:, 0], np.arange(window + 2)), table[:, 1], table[:, 2], table[:, 3],
                planned, after, n_pattern, -(-int(sizes.sum()) // window))


def id_bytes(encoder) -> int:
    """Bytes of an id in the written table."""
    return 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4


def tokenised(docs: DataFrame, tokenizer: str, kind: str, end_id: int, window: int) -> DataFrame:
    """doc_id, part, n_tokens, rest, rank (of the rest among those of its length in the
    partition), windows_before (full windows before it there) and ids, 16 bits each if the
    vocabulary allows it, else 32."""
    vocabulary = tokenizer_path(tokenizer)

    def run(batches):
        part, encoder = TaskContext.get().partitionId(), None
        seen = np.zeros(window, np.int64)
        windows = 0
        for piece in sliced(batches, most=SLICE_BYTES):
            encoder = encoder or shared_encoder(vocabulary, kind)
            ids, at = encoder.encode(text_array(piece.column("text")))
            n = np.diff(at) + 1
            rest = n % window
            order = np.argsort(rest, kind="stable")
            first = np.searchsorted(rest[order], rest[order], side="left")
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n)) - first
            rank += seen[rest]
            seen += np.bincount(rest, minlength=window)
            full = n // window
            before = windows + np.cumsum(full) - full
            windows += int(full.sum())
            size = id_bytes(encoder)
            flat = np.asarray(ids).astype(f"<u{size}").tobytes()
            end = int(end_id).to_bytes(size, "little")
            raw = [flat[size * a:size * b] + end for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id"), "part": pa.array(np.full(len(n), part, np.int32)),
                "n_tokens": pa.array(n), "rest": pa.array(rest.astype(np.int32)), "rank": pa.array(rank),
                "windows_before": pa.array(before), "ids": pa.array(raw, pa.binary())})

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind_of_id}, part int, n_tokens long, rest int, rank long, windows_before long, ids binary")


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", kind: str = "byte", end_id: int = 0,
         window: int = 1024) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, and ids as
    little-endian unsigned 32-bit integers."""
    table = write_once(tokenised(docs, tokenizer, kind, end_id, window), "tokens")
    counts = table.groupBy("part", "rest").agg(
        F.count("*").alias("n"), F.sum(F.expr(f"n_tokens div {window}")).alias("full"))
    counts = write_once(counts, "rest-counts")
    histogram = np.zeros(window, np.int64)
    for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect():  # below ``window`` rows
        histogram[r["rest"]] = r["n"]
    plan = make_plan(histogram, window)
    first_full = plan.n_pattern + plan.n_left

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_rest = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("full").alias("full"))  # one row per written partition
    parts = parts.select("part", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_before"))
    shifts = counts.select("part", "rest", F.coalesce(F.sum("n").over(by_rest), F.lit(0)).alias("rank_before"))
    # One row per written partition, with an array of its shifts by length.
    shifts = shifts.groupBy("part").agg(F.collect_list(F.struct("rest", "rank_before")).alias("known")).mapInArrow(dense(window), "part int, shift array<long>")
    placed = table.join(shifts.join(parts, "part"), "part").select(
        "doc_id", "n_tokens", "rest", (F.col("rank") + F.element_at("shift", F.col("rest") + 1)).alias("rank"),
        (F.col("windows_before") + F.col("full_before") + first_full).alias("first_window"), "ids")

    def run(batches):
        for batch in batches:
            cols = batch.select(["doc_id", "n_tokens", "rest", "rank", "first_window"]).to_pydict()
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
            size = 0
            for k, raw in enumerate(batch.column("ids")):
                raw = raw.as_buffer().to_pybytes()
                n, rest = cols["n_tokens"][k], cols["rest"][k]
                if len(raw) == 2 * n:
                    raw = np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                pieces = [(j * window, window, cols["first_window"][k] + j, 0) for j in range(n // window)]
                if rest:
                    pieces += [(n - rest + s, m, q, o) for s, m, q, o in plan.place(rest, cols["rank"][k])]
                for s, m, q, o in pieces:
                    for name, value in zip(out, (cols["doc_id"][k], s, m, n, q, o, raw[4 * s:4 * (s + m)])):
                        out[name].append(value)
                size += len(raw)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pydict(out, schema=schema(batch))
                    out, size = {name: [] for name in out}, 0
            if out["start"]:
                yield pa.RecordBatch.from_pydict(out, schema=schema(batch))

    def schema(batch):
        return pa.schema([("doc_id", batch.schema.field("doc_id").type), *[(k, pa.int64()) for k in ("start", "length", "doc_tokens", "sequence_id", "offset")], ("ids", pa.binary())])

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind_of_id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def dense(window: int):
    """Task: (length, value) pairs of a row as an array over all lengths, 0 where there is none."""
    def run(batches):
        for batch in batches:
            known = batch.column("known")
            pairs = known.flatten()
            table = np.zeros((batch.num_rows, window), np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(known.offsets)))
            table[row, np.asarray(pairs.field("rest"))] = np.asarray(pairs.field("rank_before"))
            offsets = pa.array(np.arange(batch.num_rows + 1) * window, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))], names=["part", "shift"])

    return run


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
