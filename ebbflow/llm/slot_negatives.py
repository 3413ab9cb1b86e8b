"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive asks for the best
rows of another label whose score lies in a window below its own: at least ``low`` and at most
``high`` percent of it. The windows overlap, but their upper limits, in descending order, cut
the scores into disjoint slots: a score belongs to the lowest limit that it does not exceed.
It is enough to keep ``k`` rows in every slot: the best of a window are among the first ``k``
of its own slot and all lower ones, so one merge from the lowest slot upwards answers all
windows of the anchor, and the lower limit cuts each answer's tail.

Anchors and rows meet in a grid of bounded groups (``ANCHORS`` x ``ROWS``), dealt by a row
number, so neither a common label nor copies of a vector make a group larger. In a group,
anchors come first and rows stream past them in chunks of numpy products; running
selections (the combiners) keep the best per anchor, or per anchor and slot. Spark merges the
selections of all groups with ranked windows, which again cut before the shuffle.

Components are floor(``scale`` * x); products and sums are exact integers.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part, nor do vectors of another length than the most common one; a row is no partner
of itself, but repeated rows are rows of their own (with equal ids, order among them is open
and their values are the same); scores beyond +-2**56 count as that limit; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow.llm.store import write_once
from ebbflow.llm.vectors import CHUNK, binary, common_length, first_k, matrix, usable

#: Anchors and rows of one group of the grid at most (in expectation).
ANCHORS = 2048
ROWS = 262_144
#: Scores are cut off at this size.
MOST = 1 << 56

ROW_SCHEMA = "vec_id long, label long, vec binary"
FOUND = "anchor long, slot int, vec_id long, score long"


def integer_rows(embeddings: DataFrame, label: Column, scale: int, length: int) -> DataFrame:
    """A written table of the rows that take part: row number, vec_id, label, and the integer
    components as 16-bit numbers, or as doubles where one does not fit."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.floor(np.asarray(batch.column("embedding").flatten(), np.float64).reshape(-1, length) * scale)
            wide = (np.abs(values) > 32767).any(axis=1)
            for part, dtype in ((~wide, "<i2"), (wide, "<f8")):
                if part.any():
                    keep = pa.array(part)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id").filter(keep), batch.column("label").filter(keep), binary(values[part].astype(dtype))],
                        names=["vec_id", "label", "vec"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") == length) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return write_once(rows.mapInArrow(run, ROW_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "integer-rows")


def components(column: pa.Array, length: int) -> np.ndarray:
    """Integer components as doubles; 16-bit rows and double rows may be mixed."""
    sizes = np.diff(np.frombuffer(column.cast(pa.large_binary()).buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1])
    out = np.zeros((len(column), length))
    for dtype, size in (("<i2", 2 * length), ("<f8", 8 * length)):
        at = sizes == size
        if at.any():
            out[at] = matrix(column.filter(pa.array(at)), dtype, length)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as 64-bit integers (cut off at +-MOST)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def best_of_rows(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) positions of the ``k`` highest valid scores in every row of ``scores``,
    earlier columns first among equal scores; in no order."""
    n = scores.shape[1]
    if n > k and len(scores) and np.abs(scores).max() < (1 << 62) // n:
        key = np.where(valid, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        at = np.argpartition(key, n - k, axis=1)[:, n - k:]
        row, col = np.repeat(np.arange(len(scores)), k), at.ravel()
        keep = valid[row, col]
        return row[keep], col[keep]
    row, col = np.nonzero(valid)
    at = first_k(row, scores[row, col], col, k)
    return row[at], col[at]


class Combiner:
    """Running selection of the ``k`` best rows for every (anchor, slot)."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, anchor: np.ndarray, slot: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        self.held.append((anchor, slot, vec_id, score))
        self.size += len(anchor)
        if self.size > 1 << 20:
            self.merge()

    def merge(self) -> tuple[np.ndarray, ...]:
        anchor, slot, vec_id, score = (np.concatenate(x) for x in zip(*self.held)) if self.held else [np.zeros(0, np.int64)] * 4
        at = first_k(anchor * 1024 + slot, score, vec_id, self.k)
        self.held = [(anchor[at], slot[at], vec_id[at], score[at])]
        self.size = len(at)
        return self.held[0]


def grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, select, k: int, length: int) -> DataFrame:
    """``select(anchor columns, scores, same label, other row)`` for every chunk of every group
    of the grid gives (slot, anchor position, row position) candidates; returns the ``k`` best
    per (anchor, slot) of each group."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    across, down = max(1, math.ceil(n_anchors / ANCHORS)), max(1, math.ceil(n_rows / ROWS), min(2 * cores, math.ceil(n_rows / CHUNK)))
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select(deal(across, 1).alias("ag"), every(down).alias("rg"), F.lit(0).alias("kind"), "row", "vec_id", "label", "vec", "limits")
    right = rows.select(every(across).alias("ag"), deal(down, 2).alias("rg"), F.lit(1).alias("kind"), "row", "vec_id", "label", "vec",
                        F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("limits"))

    def run(batches):
        key, parts, a, combiner = None, [], None, Combiner(k)

        def flush():
            anchor, slot, vec_id, score = combiner.merge()
            if len(anchor):
                yield pa.RecordBatch.from_arrays([pa.array(a["row"][anchor]), pa.array(slot.astype(np.int32)), pa.array(vec_id), pa.array(score)],
                                                 names=["anchor", "slot", "vec_id", "score"])

        for batch in batches:
            keys = np.asarray(batch.column("ag"), np.int64) << 33 | np.asarray(batch.column("rg"), np.int64) << 1 | np.asarray(batch.column("kind"), np.int64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                if stop == start:
                    continue
                piece, group = batch.slice(start, stop - start), int(keys[start]) >> 1
                if group != key:
                    yield from flush()
                    key, parts, a, combiner = group, [], None, Combiner(k)
                if not keys[start] & 1:
                    parts.append(piece)
                    continue
                if a is None:
                    a = gathered(parts, length)
                for at in range(0, piece.num_rows, CHUNK):
                    r = gathered([piece.slice(at, CHUNK)], length)
                    order = np.argsort(r["vec_id"], kind="stable")
                    r = {n: x[order] for n, x in r.items() if n != "limits"}
                    if not len(a["row"]):
                        continue
                    score = products(a["vec"], r["vec"])
                    same, other = a["label"][:, None] == r["label"], a["row"][:, None] != r["row"]
                    for slot, valid in select(a, score, same, other):
                        x, y = best_of_rows(score, valid, k)
                        combiner.add(x, np.full(len(x), slot), r["vec_id"][y], score[x, y])
        yield from flush()

    parts = min(across * down, max(cores, spark_partitions(spark)))
    return left.unionByName(right).repartition(parts, "ag", "rg").sortWithinPartitions("ag", "rg", "kind").mapInArrow(run, FOUND)


def spark_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gathered(pieces: list, length: int) -> dict:
    """Columns of some record batches as numpy arrays."""
    table = pa.Table.from_batches(pieces).combine_chunks() if pieces else None
    if table is None:
        return {"row": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "label": np.zeros(0, np.int64), "vec": np.zeros((0, length)), "limits": []}
    one = lambda n: table.column(n).combine_chunks()
    return {n: np.asarray(one(n), np.int64) for n in ("row", "vec_id", "label")} | {"vec": components(one("vec"), length), "limits": one("limits").to_pylist() if table.column("limits").null_count == 0 else []}


def first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """For each row of ``embeddings`` (vec_id, embedding, label) that satisfies ``anchor``
    (a condition on vec_id), and each of its ``positives`` best rows of the same label: the
    ``negatives`` best rows of another label whose score is between ``low`` and ``high``
    percent of the positive's. ``label`` replaces the label column."""
    rows = usable(embeddings.withColumn("label", F.col("label") if label is None else label))
    length = common_length(rows)
    rows = integer_rows(rows, F.col("label"), scale, length)
    n_rows = rows.count()
    no_limits = F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("limits")
    chosen = rows.where(anchor)
    n_anchors = chosen.count()

    def same_label(a, score, same, other):
        yield 0, same & other

    near = first_of(grid(chosen.select("*", no_limits), rows, n_anchors, n_rows, same_label, positives, length), ["anchor"], positives)
    percent = lambda sign, p: f"{sign}cast(({sign}score * {p} - pmod({sign}score * {p}, 100)) div 100 AS bigint)"
    window = F.expr(f"named_struct('low', {percent('-', low)}, 'high', {percent('', high)})")
    asked = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", window.alias("window")))).alias("asked"))
    asked = write_once(asked, "positives")

    def slots(a, score, same, other):
        """Candidates of each slot: scores up to its limit, above the next one, and not under
        the lowest bound of the windows that reach down to it."""
        limits = np.array([[(w["low"], w["high"]) for w in x] + [(0, -4 * MOST)] * (positives - len(x)) for x in a["limits"]], np.int64).reshape(-1, positives, 2)
        ends = np.concatenate([limits[:, :, 1], np.full((len(limits), 1), -4 * MOST)], axis=1)
        for j in range(positives):
            low_, high_, below = limits[:, j, 0], ends[:, j], ends[:, j + 1]
            if (np.maximum(low_, below + 1) <= high_).any():
                yield j, ~same & (score <= high_[:, None]) & (score > below[:, None]) & (score >= low_[:, None])

    with_limits = chosen.join(asked.select(F.col("anchor").alias("row"), F.col("asked.window").alias("limits")), "row")
    kept = first_of(grid(with_limits, rows, n_anchors, n_rows, slots, negatives, length), ["anchor", "slot"], negatives)

    # Slots in ascending order of score; the merge puts each slot before all lower ones.
    by_slot = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "vec_id", "score"))).alias("found"))
    slot = lambda j: F.transform(F.filter("found", lambda x: x.slot == j), lambda x: F.struct(x.vec_id.alias("vec_id"), x.score.alias("score")))
    suffix = None
    answers = []
    for j in range(positives - 1, -1, -1):
        suffix = F.slice(slot(j) if suffix is None else F.concat(slot(j), suffix), 1, negatives)
        answers.append(suffix)
    merged = by_slot.select("anchor", F.array(*answers[::-1]).alias("answers"))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = merged.join(asked, "anchor").join(ids, "anchor").select("anchor_id", "answers", F.posexplode("asked").alias("j", "p"))
    out = out.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"),
                     F.posexplode(F.filter(F.col("answers")[F.col("j")], lambda x: x.score >= F.col("p.window.low"))).alias("at", "n"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
                      "positive_score", F.col("n.score").alias("negative_score"))
