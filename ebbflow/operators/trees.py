"""Tree ensembles grown from shared histograms.

Features are cut into quantile bins once and the rows are written as packed blocks. All fits
(every configuration on every fold, and on all training rows) then grow in the same Spark
jobs. A job is one pass over the blocks: a task adds up, for every open node of every fit, the
gradients, hessians and rows per (feature, bin); the sums are shuffled on (fit, tree, node),
added, and each node's best split is found where its histogram lies. Only the best splits (a
few numbers a node, at most ``NODES`` nodes a pass) reach the driver, which extends the trees.
Fits do not wait for each other: each is at its own tree and depth.

A boosted fit has its trees one after the other, some hundreds of passes. Up to ``ALONE`` rows these
cost more than the sums do: then a task takes a copy of all blocks and grows the whole fit, and
all fits are one job. Forests up to ``SUBTREE`` rows join it, some trees of a fit in each task.

* Boosting: gradients and hessians of the logistic loss at the margin of the trees so far. The
  gain is G^2 / (D + l2) summed over the children minus the parent, D being the hessian
  (Newton gain) or the row count (squared error on residuals); a leaf's value is the Newton
  step G / (H + l2), times the rate.
* A leaf limit grows best-first: the open leaf with the largest gain is split next. The order
  is replayed on the known gains after every pass, and only leaves that it reaches stay open,
  which gives the tree that one split at a time would give.
* Row subsampling, Poisson bagging and the features tried in a node are hashes of the row (its
  content), the tree and the node, so a retried task draws the same rows.
* Forest: trees are independent; a node is not split below ``min_split`` rows, depth is unbounded
  if the configuration says so. Only nodes of more than ``SUBTREE`` rows (of smaller tables none) are
  split by passes. The rows of a smaller one go to one group, which grows the whole subtree and
  also takes the held-out rows that fall into it. A forest has about as many nodes as rows times
  trees, so its trees stay in a written table, and what they give each held-out row is added up
  there (in the order of the trees). The driver reads the trees only when a model is used.

A block's margins follow from the trees alone. A task keeps them in the Python worker between
passes and applies only trees that it has not seen; a worker that never saw the block starts
from the first tree, so nothing is lost with an executor.

Null and NaN features fall into the first bin. Rows with a null label take no part. A fit
without rows, or with one class only, gives trees without splits and a constant probability.
"""

from __future__ import annotations

import itertools
import json
import math
import sys
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbflow.session import materialize

#: Bins of a feature and rows of a block at most, nodes whose histograms one pass makes.
BINS, BLOCK_ROWS, NODES = 128, 16_384, 1500
#: Rows of a block at least, where smaller blocks would keep more cores busy.
LEAST_ROWS = 4096
#: Gains within this share of the best are equal; the first feature and bin win.
EQUAL = 1e-9
#: Rows of a forest's node from which one group grows the rest, (row, tree) pairs shuffled at once,
#: and cells of the histograms made at once.
SUBTREE, WAVE, CELLS = 1 << 20, 200_000_000, 1 << 19
#: Rows up to which one task grows a boosted fit, cells at most that features of few bins share, and
#: tasks a core over which the trees of forests are dealt.
ALONE, JOINT, DEALT = 1 << 20, 512, 8


@dataclass(frozen=True)
class TreeSpec:
    """One configuration. ``weights``: none, "balanced", or the weight of label 1."""

    name: str
    trees: int
    rate: float = 0.1
    depth: int | None = None
    leaves: int | None = None
    forest: bool = False
    by_hessian: bool = True
    l2: float = 0.0
    min_rows: int = 1
    min_split: int = 2
    min_hessian: float = 0.0
    subsample: float = 1.0
    weights: str | float | None = None
    from_prior: bool = True
    max_features: int | None = None


@dataclass
class Trees:
    """Finished trees of one fit, one after the other: node arrays, and each tree's first node."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int16))
    bin: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int16))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    first: list[int] = field(default_factory=list)

    def add(self, feature, bin_, left, value) -> None:
        self.first.append(len(self.feature))
        self.feature = np.concatenate([self.feature, np.asarray(feature, np.int16)])
        self.bin = np.concatenate([self.bin, np.asarray(bin_, np.int16)])
        self.left = np.concatenate([self.left, np.asarray(left, np.int32)])
        self.value = np.concatenate([self.value, np.asarray(value, float)])

    def sums(self, bins: np.ndarray, start: int = 0) -> np.ndarray:
        """Sum over the trees from ``start`` of the leaf value that each row falls into."""
        out = np.zeros(len(bins))
        ends = [*self.first[1:], len(self.feature)]
        for a, b in zip(self.first[start:], ends[start:]):
            out += self.value[a:b][leaf_of(bins, self.feature[a:b], self.bin[a:b], self.left[a:b])]
        return out


class StoredTrees:
    """The trees of a forest's fit in a written table: read by the first use of an array."""

    def __init__(self, table: DataFrame, fit: int, tops: list):
        self.source = table, fit, tops

    def __getattr__(self, name: str):
        if name not in Trees.__dataclass_fields__:
            raise AttributeError(name)
        table, fit, tops = self.source
        found: dict[int, list] = {}
        for r in table.where((F.col("fit") == fit) & (F.col("block") < 0)).orderBy("tree", "root").toArrow().to_pylist():
            found.setdefault(r["tree"], []).append(r)
        whole = Trees()
        for k, top in enumerate(tops):
            columns = [np.array(c) for c in top]
            for r in found.get(k, []):
                below = arrays_of(r)
                below[2] = np.where(below[0] >= 0, below[2] + len(columns[0]) - 1, 0)  # its root takes a place that is there
                for c, x in zip(columns, below):
                    c[r["root"]] = x[0]
                columns = [np.concatenate([c, x[1:]]) for c, x in zip(columns, below)]
            whole.add(*columns)
        self.__dict__.update(whole.__dict__)
        return self.__dict__[name]

    def __reduce__(self):
        return Trees, tuple(getattr(self, n) for n in Trees.__dataclass_fields__)

    sums = Trees.sums


def leaf_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Node without a split that each row reaches; the children of a node are left, left + 1."""
    node = np.zeros(len(bins), np.int64)
    rows = np.flatnonzero(feature[node] >= 0)
    while len(rows):
        at = node[rows]
        node[rows] = left[at] + (bins[rows, feature[at]] > cut[at])
        rows = rows[feature[node[rows]] >= 0]
    return node


def mix(x: np.ndarray, *salts: int) -> np.ndarray:
    """Hash of 64-bit integers and some small numbers."""
    x = np.asarray(x).astype(np.int64).view(np.uint64).copy()
    with np.errstate(over="ignore"):
        for s in (0, *salts):
            x = (x ^ np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
    return x


def uniform(x: np.ndarray, *salts: int) -> np.ndarray:
    return (mix(x, *salts) >> np.uint64(11)) / float(1 << 53)


#: Cumulative Poisson(1) probabilities of 0, 1, 2, ... draws.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def drawn(spec: TreeSpec, fit: int, tree: int, row_hash: np.ndarray) -> np.ndarray:
    """How often each row counts in a tree."""
    if spec.forest:
        return np.searchsorted(POISSON, uniform(row_hash, fit, tree)).astype(float)
    if spec.subsample < 1:
        return (uniform(row_hash, fit, tree) < spec.subsample).astype(float)
    return np.ones(len(row_hash))


def tried(spec: TreeSpec, fit: int, tree: int, node: int, n: int) -> np.ndarray:
    """Features that a node looks at (see ``tried_by`` for many nodes)."""
    if not spec.max_features or spec.max_features >= n:
        return np.arange(n)
    return np.sort(np.argsort(mix(np.arange(n), fit, tree, node), kind="stable")[:spec.max_features])


def tried_by(spec: TreeSpec, fit: int, tree: int, root: int, nodes: np.ndarray, n: int) -> np.ndarray:
    """Features that each node looks at, numbered from the ``root`` of its subtree."""
    if not spec.max_features or spec.max_features >= n:
        return np.tile(np.arange(n), (len(nodes), 1))
    salts = (fit, tree, nodes[:, None]) if root == 0 else (fit, tree, root, nodes[:, None])
    return np.sort(np.argpartition(mix(np.arange(n), *salts), spec.max_features - 1, axis=1)[:, :spec.max_features], axis=1)


# --- rows as binned blocks ---------------------------------------------------------------------

def cuts_of(rows: DataFrame, feature_cols: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper limits of each feature's bins but the last: its quantiles, as midpoints between
    neighbouring ones where the feature has few values."""
    share = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    got = rows.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), share, F.lit(100 * bins)).alias(f"q{i}")
                     for i, c in enumerate(feature_cols)]).first()
    out = []
    for i in range(len(feature_cols)):
        q = np.unique(np.array(got[f"q{i}"] or [], float))
        out.append(((q[1:] + q[:-1]) / 2).tolist())
    return out


def binned(batch: pa.RecordBatch, names: Sequence[str], cuts: list[list[float]]) -> np.ndarray:
    columns = []
    for name, c in zip(names, cuts):
        x = np.asarray(batch.column(name).fill_null(-np.inf), float)
        columns.append(np.searchsorted(np.array(c), np.where(np.isnan(x), -np.inf, x), side="left"))
    return np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros((batch.num_rows, 0), np.uint8)


BLOCK = "block long, ids array<string>, labels binary, folds binary, hashes binary, bins binary"


def blocks_of(rows: DataFrame, feature_cols: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    """A written table of packed rows (id, label, fold, features): fold -1 is held out of every fit."""
    names = [f"f{i}" for i in range(len(feature_cols))]
    wide = rows.where(F.col("label").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"),
        F.coalesce(F.col("fold").cast("int"), F.lit(-1)).alias("fold"), *[F.col(c).cast("double").alias(n) for c, n in zip(feature_cols, names)])
    wide = wide.withColumn("hash", F.xxhash64("id", *names))

    def pack(batches):
        held, n, number = [], 0, itertools.count()

        def flush():
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_pydict({
                "block": [next(number)], "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.string())),
                "labels": [np.asarray(table.column("label"), np.int8).tobytes()], "folds": [np.asarray(table.column("fold"), np.int8).tobytes()],
                "hashes": [np.asarray(table.column("hash"), np.int64).tobytes()], "bins": [binned(table, names, cuts).tobytes()]})

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(a, BLOCK_ROWS))
                n += held[-1].num_rows
                if n >= BLOCK_ROWS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    # Small tables fill few blocks: no more partitions than blocks, and rows dealt evenly to them.
    n, cores = wide.count(), rows.sparkSession.sparkContext.defaultParallelism
    wide = wide.coalesce(1) if n <= BLOCK_ROWS else wide.repartition(max(math.ceil(n / BLOCK_ROWS), min(cores, n // LEAST_ROWS)))
    table = wide.mapInArrow(pack, BLOCK)
    return materialize(table.withColumn("block", F.monotonically_increasing_id()), "tree-blocks")


@dataclass
class Block:
    number: int
    labels: np.ndarray
    folds: np.ndarray
    hashes: np.ndarray
    bins: np.ndarray


def read_blocks(batches):
    for batch in batches:
        for r in batch.select(["block", "labels", "folds", "hashes", "bins"]).to_pylist():
            labels = np.frombuffer(r["labels"], np.int8)
            yield Block(r["block"], labels, np.frombuffer(r["folds"], np.int8), np.frombuffer(r["hashes"], np.int64),
                        np.frombuffer(r["bins"], np.uint8).reshape(len(labels), -1))


# --- one pass ----------------------------------------------------------------------------------

@dataclass
class Fit:
    """One configuration on one choice of rows: all folds but ``fold`` (all, if it is None)."""

    number: int
    spec: TreeSpec
    fold: int | None
    prior: float = 0.5
    weight: tuple[float, float] = (1.0, 1.0)
    done: Trees | StoredTrees = field(default_factory=Trees)
    size: int = 0
    held: DataFrame | None = None  # a forest's table: with what its trees give to held-out rows

    @property
    def start(self) -> float:
        return math.log(self.prior / (1 - self.prior)) if self.spec.from_prior and 0 < self.prior < 1 else 0.0

    def rows(self, folds: np.ndarray) -> np.ndarray:
        return (folds >= 0) & (folds != (-1 if self.fold is None else self.fold))

    def probability(self, sums: np.ndarray) -> np.ndarray:
        if self.spec.forest:
            return sums / max(1, len(self.done.first)) if self.done.first else np.full(len(sums), self.prior)
        if not 0 < self.prior < 1:
            return np.full(len(sums), self.prior)
        return 1 / (1 + np.exp(-(self.start + sums)))


@dataclass
class Growing:
    """A tree being grown: its nodes, and the open ones whose split is looked for."""

    fit: int
    tree: int
    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    level: list = field(default_factory=lambda: [0])
    sums: list = field(default_factory=lambda: [None])
    gain: list = field(default_factory=lambda: [0.0])
    known: list = field(default_factory=lambda: [False])
    open: list = field(default_factory=lambda: [0])
    small: list = field(default_factory=list)  # a forest's nodes whose subtrees are grown by groups


def worker_margins(run: str) -> dict:
    """Margins that this Python worker has for the blocks of a run; other runs' are dropped."""
    kept = sys.modules.setdefault("ebbflow_tree_margins", ModuleType("ebbflow_tree_margins")).__dict__
    if kept.get("run") != run:
        kept.update(run=run, margins={})
    return kept["margins"]


def margin(run: str, fit: Fit, block: Block) -> np.ndarray:
    kept = worker_margins(run)
    n, total = kept.get((block.number, fit.number), (0, None))
    if total is None or n > len(fit.done.first):
        n, total = 0, np.zeros(len(block.labels))
    if n < len(fit.done.first):
        total = total + fit.done.sums(block.bins, n)
        kept[block.number, fit.number] = (len(fit.done.first), total)
    return fit.start + total


def local_histograms(run: str, fits: dict[int, Fit], growing: list[Growing], widths: np.ndarray):
    """Task: sums of every open node over the blocks of a partition."""
    offsets = np.concatenate([[0], np.cumsum(widths)])
    total = int(offsets[-1])

    def task(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for block in read_blocks(batches):
            flat = block.bins.astype(np.int64) + offsets[:-1]
            shared: dict[int, tuple] = {}
            for k, t in enumerate(growing):
                fit = fits[t.fit]
                if t.fit not in shared:
                    rows = np.flatnonzero(fit.rows(block.folds))
                    y = block.labels[rows].astype(float)
                    w = np.where(y > 0, fit.weight[1], fit.weight[0])
                    if fit.spec.forest:
                        shared[t.fit] = rows, w * y, w
                    else:
                        p = 1 / (1 + np.exp(-margin(run, fit, block)[rows]))
                        shared[t.fit] = rows, w * (y - p), w * p * (1 - p)
                rows, g, h = shared[t.fit]
                times = drawn(fit.spec, fit.number, t.tree, block.hashes[rows])
                node = leaf_of(block.bins[rows], np.array(t.feature), np.array(t.bin), np.array(t.left))
                place = np.full(len(t.feature), -1)
                place[t.open] = np.arange(len(t.open))
                use = np.flatnonzero((place[node] >= 0) & (times > 0))
                if not len(use):
                    continue
                at = (place[node[use]][:, None] * total + flat[rows[use]]).ravel()
                times = times[use]
                found = np.stack([np.bincount(at, np.repeat(x, len(widths)), len(t.open) * total).reshape(-1, total)
                                  for x in (g[use] * times, h[use] * times, times)], axis=1)
                for i, name in enumerate(t.open):
                    if found[i, 2, :widths[0]].any():
                        bins = columns_of(fit.spec, t, name, offsets)
                        mine = found[i][:, bins]
                        sums[k, name] = sums[k, name] + mine if (k, name) in sums else mine
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in sums], pa.int32()), pa.array([n for _, n in sums], pa.int32()),
                 pa.array([np.ascontiguousarray(x).tobytes() for x in sums.values()], pa.binary())], names=["tree", "node", "sums"])

    return task


def columns_of(spec: TreeSpec, t: Growing, node: int, offsets: np.ndarray) -> np.ndarray:
    """Positions of the bins of a node's features in the flat histogram."""
    return np.concatenate([np.arange(offsets[f], offsets[f + 1]) for f in tried(spec, t.fit, t.tree, node, len(offsets) - 1)])


SPLITS = "tree int, node int, feature int, bin int, gain double, sums array<double>"


def best_splits(fits: dict[int, Fit], growing: list[Growing], widths: np.ndarray):
    """Task: adds the histograms of each node and finds its best split (feature -1: none)."""
    offsets = np.concatenate([[0], np.cumsum(widths)])

    def task(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, node, x in zip(batch.column("tree").to_pylist(), batch.column("node").to_pylist(), batch.column("sums").to_pylist()):
                x = np.frombuffer(x).reshape(3, -1)
                total[k, node] = total[k, node] + x if (k, node) in total else x
        rows = []
        for (k, node), x in total.items():
            t = growing[k]
            spec = fits[t.fit].spec
            features = tried(spec, t.fit, t.tree, node, len(widths))
            rows.append({"tree": k, "node": node, **best_split(spec, x, features, widths[features])})
        yield pa.RecordBatch.from_pylist(rows, schema=SPLIT_ROWS)

    return task


SPLIT_ROWS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()),
                        ("sums", pa.list_(pa.float64()))])


def best_split(spec: TreeSpec, x: np.ndarray, features: np.ndarray, widths: np.ndarray) -> dict:
    """``x``: gradient, hessian and rows per bin of the given features, one after the other.
    ``sums`` of the result are those of the left child and of the node."""
    starts = np.cumsum(widths) - widths
    whole = x[:, :widths[0]].sum(axis=1)
    run = np.cumsum(x, axis=1)
    before = np.concatenate([np.zeros((3, 1)), run], axis=1)[:, starts]
    left = run - np.repeat(before, widths, axis=1)
    right = whole[:, None] - left
    d = 1 if spec.by_hessian else 2

    def score(s):
        return np.divide(s[0] ** 2, s[d] + spec.l2, out=np.zeros_like(s[0]), where=s[d] + spec.l2 > 1e-12)

    gain = score(left) + score(right) - score(whole[:, None])
    least = max(1, spec.min_rows)
    valid = (left[2] >= least) & (right[2] >= least) & (left[1] >= spec.min_hessian) & (right[1] >= spec.min_hessian)
    valid[starts + widths - 1] = False
    gain = np.where(valid, gain, -np.inf)
    best = gain.max(initial=-np.inf)
    none = {"feature": -1, "bin": 0, "gain": 0.0, "sums": [*whole, *whole]}
    if whole[2] < spec.min_split or not best > 1e-10 * max(1.0, float(score(whole[:, None])[0])):
        return none
    at = int(np.argmax(gain >= best * (1 - EQUAL)))
    f = int(np.searchsorted(starts, at, side="right")) - 1
    return {"feature": int(features[f]), "bin": int(at - starts[f]), "gain": float(best), "sums": [*left[:, at].tolist(), *whole.tolist()]}


# --- growing -----------------------------------------------------------------------------------

def reached(t: Growing, leaves: int | None) -> list[int]:
    """Nodes split by a best-first order that stops at ``leaves`` leaves."""
    if leaves is None:
        return [n for n, f in enumerate(t.feature) if f >= 0]
    split, ready = [], [0]
    while ready and len(split) < leaves - 1:
        best = max((n for n in ready if t.feature[n] >= 0), key=lambda n: (t.gain[n], -n), default=None)
        if best is None:
            break
        ready.remove(best)
        split.append(best)
        ready += [t.left[best], t.left[best] + 1]
    return split


def extend(t: Growing, spec: TreeSpec, found: list[dict]) -> None:
    """Take in the splits of the open nodes, and open the children that may be split. Nodes are
    numbered in order, whatever the order of the results, as the features tried depend on it."""
    for r in sorted(found, key=lambda r: r["node"]):
        n = r["node"]
        t.known[n], t.sums[n] = True, np.array(r["sums"][3:])
        if r["feature"] < 0:
            continue
        t.feature[n], t.bin[n], t.gain[n], t.left[n] = r["feature"], r["bin"], r["gain"], len(t.feature)
        left = np.array(r["sums"][:3])
        for sums in (left, t.sums[n] - left):
            for column, v in zip((t.feature, t.bin, t.left, t.level, t.sums, t.gain, t.known), (-1, 0, 0, t.level[n] + 1, sums, 0.0, False)):
                column.append(v)
    for n in t.open:  # a node that no row reaches
        t.known[n] = True
    t.open = []
    for n in reached(t, spec.leaves):
        for child in (t.left[n], t.left[n] + 1):
            deep = spec.depth is not None and t.level[child] >= spec.depth
            if not t.known[child] and not deep and t.sums[child][2] >= max(spec.min_split, 2 * spec.min_rows):
                t.open.append(child)


def finished(t: Growing, spec: TreeSpec) -> tuple[list, list, list, list]:
    """Node arrays of a grown tree, numbered anew without the splits that best-first left out."""
    return numbered(t, spec)[:4]


def numbered(t: Growing, spec: TreeSpec) -> tuple[list, list, list, list, list]:
    """``finished``, and the growing tree's number of each node."""
    split = set(reached(t, spec.leaves))
    feature, cut, left, value = [], [], [], []
    queue = [0]
    for n in queue:
        inner = n in split
        feature.append(t.feature[n] if inner else -1)
        cut.append(t.bin[n])
        left.append(len(queue) if inner else 0)
        if inner:
            queue += [t.left[n], t.left[n] + 1]
        s = t.sums[n] if t.sums[n] is not None else np.zeros(3)
        d = s[1] + (0 if spec.forest else spec.l2)
        value.append((s[0] / d if d > 1e-12 else 0.0) * (1 if spec.forest else spec.rate))
    return feature, cut, left, value, queue


def prepare_fits(specs: Sequence[TreeSpec], folds: Sequence[int | None], blocks: DataFrame) -> list[Fit]:
    """Every configuration on every choice of rows, with its class weights and prior."""
    def count(batches):
        for b in read_blocks(batches):
            pairs, n = np.unique(np.stack([b.folds, b.labels]).astype(np.int64), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n)], names=["fold", "label", "n"])

    got = blocks.mapInArrow(count, "fold long, label long, n long").groupBy("fold", "label").agg(F.sum("n").alias("n")).collect()
    out = []
    for spec, fold in itertools.product(specs, folds):
        n = [sum(r["n"] for r in got if r["fold"] >= 0 and r["fold"] != fold and (r["label"] > 0) == k) for k in (False, True)]
        if spec.weights == "balanced":
            weight = tuple(sum(n) / (2 * x) if x else 1.0 for x in n)
        else:
            weight = (1.0, float(spec.weights or 1.0))
        mass = [a * b for a, b in zip(n, weight)]
        prior = mass[1] / sum(mass) if sum(mass) else 0.5
        out.append(Fit(len(out), spec, fold, prior, weight, size=sum(n)))
    return out


def grow(blocks: DataFrame, widths: Sequence[int], fits: list[Fit]) -> int:
    """Grow all trees of all fits (in place); returns the number of passes."""
    fits = [f for f in fits if 0 < f.prior < 1 and f.spec.trees]
    alone = [f for f in fits if (f.size <= SUBTREE and f.spec.leaves is None if f.spec.forest else f.size <= ALONE)]
    if alone:
        _alone(blocks, np.asarray(widths, np.int64), alone)
    others = [f for f in fits if f not in alone]
    boosted, forests = ([f for f in others if f.spec.forest == kind] for kind in (False, True))
    return (_grow(blocks, widths, boosted)[0] if boosted else 0) + (_forests(blocks, widths, forests) if forests else 0)


def _grow(blocks: DataFrame, widths: Sequence[int], fits: list[Fit]) -> tuple[int, dict]:
    """Grow by passes; forests only until their nodes are small, as (fit, tree) -> ``Growing``."""
    run, widths = uuid.uuid4().hex, np.asarray(widths, np.int64)
    blocks = blocks.select("block", "labels", "folds", "hashes", "bins")  # a pass does not need the ids
    parts = max(1, min(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    single = blocks.limit(2).count() < 2  # then there is nothing to add up
    of = {f.number: f for f in fits}
    active = [Growing(f.number, 0) for f in fits if not f.spec.forest and 0 < f.prior < 1 and f.spec.trees]
    waiting = [(f.number, k) for f in fits if f.spec.forest for k in range(f.spec.trees)]
    tops: dict[tuple[int, int], Growing] = {}
    passes = 0
    while active or waiting:
        nodes = sum(len(t.open) for t in active)
        while waiting and nodes < NODES:
            active.append(Growing(*waiting.pop(0)))
            nodes += 1
        chosen, nodes = [], 0
        for t in active:
            if not chosen or nodes + len(t.open) <= 2 * NODES:
                chosen.append(t)
                nodes += len(t.open)
        needed = {t.fit: of[t.fit] if not of[t.fit].spec.forest else replace(of[t.fit], done=Trees()) for t in chosen}
        sent = [Growing(t.fit, t.tree, t.feature, t.bin, t.left, [], [], [], [], t.open) for t in chosen]
        sums = blocks.mapInArrow(local_histograms(run, needed, sent, widths), "tree int, node int, sums binary")
        if not single:
            sums = sums.repartition(max(1, min(parts, nodes // 16)), "tree", "node")
        light = {k: replace(f, done=Trees()) for k, f in needed.items()}
        found: dict[int, list] = {}
        for r in sums.mapInArrow(best_splits(light, sent, widths), SPLITS).toArrow().to_pylist():
            found.setdefault(r["tree"], []).append(r)
        passes += 1
        for k, t in enumerate(chosen):
            fit = of[t.fit]
            extend(t, fit.spec, found.get(k, []))
            if fit.spec.forest and fit.spec.leaves is None:
                t.small += [n for n in t.open if t.sums[n][2] <= SUBTREE]
                t.open = [n for n in t.open if t.sums[n][2] > SUBTREE]
            if t.open:
                continue
            active.remove(t)
            if fit.spec.forest:
                tops[t.fit, t.tree] = t
            else:
                fit.done.add(*finished(t, fit.spec))
                if t.tree + 1 < fit.spec.trees:
                    active.append(Growing(t.fit, t.tree + 1))
    return passes, tops


# --- fits of few rows --------------------------------------------------------------------------

def _alone(blocks: DataFrame, widths: np.ndarray, fits: list[Fit]) -> None:
    """Grow fits in one job: a task takes all blocks and grows a boosted fit, or some trees of a forest."""
    forests, boosted = [f for f in fits if f.spec.forest], [f for f in fits if not f.spec.forest]
    work = lambda f: f.spec.trees * min(f.spec.leaves or 1 << 30, 1 << min(f.spec.depth or 30, 30))
    units = [(f.number, 0, f.spec.trees) for f in sorted(boosted, key=work, reverse=True)]  # the longest first
    step = max(1, math.ceil(sum(f.spec.trees for f in forests) / (DEALT * blocks.sparkSession.sparkContext.defaultParallelism)))
    units += [(f.number, k, min(step, f.spec.trees - k)) for f in forests for k in range(0, f.spec.trees, step)]
    of = {f.number: replace(f, done=Trees(), held=None) for f in fits}
    copies = blocks.select("block", "labels", "folds", "hashes", "bins", F.explode(F.sequence(F.lit(0), F.lit(len(units) - 1))).alias("unit"))
    grown = materialize(copies.repartitionById(len(units), F.col("unit")).mapInArrow(unit_trees(of, units, widths), GROWN), "trees")
    found: dict[int, Trees] = {f.number: Trees() for f in boosted}
    for r in grown.where(F.col("fit").isin([*found])).orderBy("fit", "tree").toArrow().to_pylist() if found else []:
        found[r["fit"]].add(*arrays_of(r))
    for f in boosted:
        while len(found[f.number].first) < f.spec.trees:  # there is no block
            found[f.number].add(*finished(Growing(f.number, 0), f.spec))
        f.done = found[f.number]
    for f in forests:
        f.done, f.held = StoredTrees(grown, f.number, [finished(Growing(f.number, k), f.spec) for k in range(f.spec.trees)]), grown


def arrays_of(r: dict) -> list[np.ndarray]:
    """Node arrays of a row of ``GROWN``."""
    return [np.frombuffer(r[n], t) for n, t in (("feature", np.int16), ("bin", np.int16), ("left", np.int32), ("value", float))]


def unit_trees(fits: dict[int, Fit], units: list[tuple[int, int, int]], widths: np.ndarray):
    """Task: the trees (fit, first, number) of a unit from all blocks, and for a forest what they give
    the held-out rows of each block, added up in the order of the trees."""
    def task(batches):
        found: dict[int, list[Block]] = {}
        for batch in batches:
            for unit, block in zip(batch.column("unit").to_pylist(), read_blocks([batch])):
                found.setdefault(unit, []).append(block)
        for unit, own in found.items():
            number, first, trees = units[unit]
            fit = fits[number]
            own.sort(key=lambda b: b.number)  # in order: the sums are the same, whatever came first
            whole = [np.concatenate([getattr(b, n)[fit.rows(b.folds)] for b in own]) for n in ("bins", "labels", "hashes")]
            out = {n: [] for n in ("tree", "block", "feature", "bin", "left", "value", "held")}

            def add(tree, block, feature, cut, left, value, held=b""):
                for n, x in zip(out, (tree, block, feature, cut, left, value, held)):
                    out[n].append(x)

            if fit.spec.forest:
                held = [np.flatnonzero(b.folds == (-1 if fit.fold is None else fit.fold)).astype(np.int32) for b in own]
                held_bins = np.concatenate([b.bins[rows] for b, rows in zip(own, held)])
                total = np.zeros(len(held_bins))
                for k in range(first, first + trees):
                    times = np.minimum(drawn(fit.spec, number, k, whole[2]), 255)
                    rows = np.flatnonzero(times > 0)
                    tree = subtree(fit, k, 0, 0, whole[0][rows], whole[1][rows], times[rows], widths)
                    add(k, -1, *(x.tobytes() for x in tree))
                    total += tree[3][leaf_of(held_bins, *tree[:3])]
                ends = np.cumsum([len(rows) for rows in held])
                for b, rows, values in zip(own, held, np.split(total, ends[:-1])):
                    if len(rows):
                        add(first, b.number, b"", b"", b"", values.tobytes(), rows.tobytes())
            else:
                for k, tree in enumerate(boosted_trees(fit, *whole, widths)):
                    add(k, -1, *(np.asarray(x, t).tobytes() for x, t in zip(tree, (np.int16, np.int16, np.int32, float))))
            n = len(out["tree"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int32()), pa.array(out["tree"], pa.int32()), pa.array([0] * n, pa.int32()), pa.array(out["block"], pa.int64()),
                 *[pa.array(out[c], pa.binary()) for c in ("feature", "bin", "left", "value", "held")]], names=GROWN_NAMES)

    return task


class JointBins:
    """Bins of all rows, made for histograms: features of few bins share a code of at most ``JOINT``
    values, so that a row is added up once for all of them; their own sums are taken from the code's."""

    def __init__(self, bins: np.ndarray, widths: np.ndarray):
        self.total, offsets = int(widths.sum()), np.concatenate([[0], np.cumsum(widths)])
        groups: list[list[int]] = []
        for f in np.argsort(widths, kind="stable"):
            if groups and math.prod(int(widths[k]) for k in groups[-1]) * int(widths[f]) <= JOINT:
                groups[-1].append(int(f))
            else:
                groups.append([int(f)])
        self.codes, self.sizes, self.columns, self.parts = [], [], [], []
        for group in groups:
            code, size = np.zeros(len(bins), np.intp), 1
            for f in group:
                code += bins[:, f].astype(np.intp) * size
                size *= int(widths[f])
            self.codes.append(code)
            self.sizes.append(size)
            self.columns.append(np.concatenate([np.arange(offsets[f], offsets[f + 1]) for f in group]))
            values, parts, below = np.arange(size), [], 1
            for f in group:
                parts.append((values // below % widths[f])[:, None] == np.arange(widths[f]))
                below *= int(widths[f])
            self.parts.append(np.concatenate(parts, axis=1).astype(float) if len(group) > 1 else None)

    def sums(self, place: np.ndarray, n: int, weights: list[np.ndarray | None]) -> np.ndarray:
        """Sums of each weight (None: 1) by (node, weight, bin) over the rows in the nodes ``place`` < n."""
        out = np.empty((n, len(weights), self.total))
        for code, size, columns, part in zip(self.codes, self.sizes, self.columns, self.parts):
            at = place * size
            at += code
            for k, w in enumerate(weights):
                found = np.bincount(at, w, (n + 1) * size)[:n * size].reshape(n, size)
                out[:, k, columns] = found if part is None else found @ part
        return out


def boosted_trees(fit: Fit, bins: np.ndarray, labels: np.ndarray, hashes: np.ndarray, widths: np.ndarray):
    """The trees of a boosted fit on the given rows, as passes would grow them."""
    spec, joint, offsets = fit.spec, JointBins(bins, widths), np.concatenate([[0], np.cumsum(widths)])
    y = labels.astype(float)
    w = np.where(y > 0, fit.weight[1], fit.weight[0])
    total = np.zeros(len(y))
    for k in range(spec.trees):
        p = 1 / (1 + np.exp(-(fit.start + total)))
        g, h, times = w * (y - p), w * p * (1 - p), None
        if spec.subsample < 1:
            times = drawn(spec, fit.number, k, hashes)
            g, h = g * times, h * times
        t, node = Growing(fit.number, k), np.zeros(len(y), np.int32)
        while t.open:
            place = np.full(len(t.feature), len(t.open))
            place[t.open] = np.arange(len(t.open))
            sums, found = joint.sums(place[node], len(t.open), [g, h, times]), []
            for x, name in zip(sums, t.open):
                if x[2, :widths[0]].any():
                    features = tried(spec, t.fit, t.tree, name, len(widths))
                    mine = x if len(features) == len(widths) else x[:, columns_of(spec, t, name, offsets)]
                    found.append({"node": name, **best_split(spec, mine, features, widths[features])})
            extend(t, spec, found)
            feature = np.array(t.feature)
            rows = np.flatnonzero((feature >= 0)[node])
            at = node[rows]
            node[rows] = np.array(t.left)[at] + (bins[rows, feature[at]] > np.array(t.bin)[at])
        *tree, kept = numbered(t, spec)
        value = np.full(len(t.feature), np.nan)
        value[kept] = tree[3]
        for n in range(len(value)):  # splits that best-first left out: their rows stay above
            if t.feature[n] >= 0 and np.isnan(value[t.left[n]]):
                value[t.left[n]:t.left[n] + 2] = value[n]
        total = total + value[node]
        yield tree


# --- subtrees of forests -----------------------------------------------------------------------

def _forests(blocks: DataFrame, widths: Sequence[int], fits: list[Fit]) -> int:
    """Grow all trees of forests: ``done`` and ``held`` of the fits read a written table."""
    widths = np.asarray(widths, np.int64)
    passes, tops = _grow(blocks, widths, [f for f in fits if f.size > SUBTREE or f.spec.leaves is not None])
    for f in fits:
        for k in range(f.spec.trees):
            tops.setdefault((f.number, k), Growing(f.number, k, open=[], small=[0]))
    of = {f.number: replace(f, done=Trees(), held=None) for f in fits}
    light = {key: (finished(t, of[t.fit].spec), {n: t.level[n] for n in t.small}) for key, t in sorted(tops.items())}
    waves, pairs = [[]], 0
    for key in light:
        if waves[-1] and pairs + of[key[0]].size > WAVE:
            waves.append([])
            pairs = 0
        waves[-1].append(key)
        pairs += of[key[0]].size
    table = None
    for keys in waves:
        own = {key: light[key] for key in keys}
        groups = sum(max(1, len(small)) for _, small in own.values())
        parts = max(1, min(groups, 16 * blocks.sparkSession.sparkContext.defaultParallelism))
        rows = blocks.select("block", "labels", "folds", "hashes", "bins").mapInArrow(subtree_rows(of, own), SUBTREE_ROWS).repartition(parts, "fit", "tree", "root")
        grown = rows.groupBy("fit", "tree", "root").applyInArrow(subtree_of(of, {key: x[1] for key, x in own.items()}, widths), GROWN)
        grown = materialize(grown, "forest")
        table = grown if table is None else table.unionByName(grown)
    for f in fits:
        f.done = StoredTrees(table, f.number, [light[f.number, k][0] for k in range(f.spec.trees)])
        f.held = table
    return passes


SUBTREE_ROWS = "fit int, tree int, root int, block long, labels binary, times binary, bins binary, held binary, held_bins binary, value binary"
GROWN = "fit int, tree int, root int, block long, feature binary, bin binary, left binary, value binary, held binary"
GROWN_NAMES = [c.split()[0] for c in GROWN.split(", ")]


def subtree_rows(fits: dict[int, Fit], trees: dict[tuple[int, int], tuple]):
    """Task: the rows of each block that a subtree grows from, and the held-out ones that fall into
    it. What falls into a leaf that is finished has its value already, and a group of its block."""
    def task(batches):
        for block in read_blocks(batches):
            for (number, k), ((feature, cut, left, value), small) in trees.items():
                fit = fits[number]
                rows = np.flatnonzero(fit.rows(block.folds))
                times = np.minimum(drawn(fit.spec, number, k, block.hashes[rows]), 255).astype(np.uint8)
                rows, times = rows[times > 0], times[times > 0]
                held = np.flatnonzero(block.folds == (-1 if fit.fold is None else fit.fold)).astype(np.int32)
                arrays = np.array(feature), np.array(cut), np.array(left)
                at, held_at = leaf_of(block.bins[rows], *arrays), leaf_of(block.bins[held], *arrays)
                out = []
                for root in small:
                    own, mine = at == root, held[held_at == root]
                    if own.any() or len(mine):
                        out.append((root, block.labels[rows[own]].tobytes(), times[own].tobytes(), block.bins[rows[own]].tobytes(), mine.tobytes(),
                                    block.bins[mine].tobytes(), b""))
                rest = ~np.isin(held_at, np.array(list(small), np.int64))
                if rest.any():
                    out.append((-1 - block.number % (1 << 30), b"", b"", b"", held[rest].tobytes(), b"", np.array(value, float)[held_at[rest]].tobytes()))
                if out:
                    root, *data = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(out), pa.int32()), pa.array([k] * len(out), pa.int32()), pa.array(root, pa.int32()),
                         pa.array([block.number] * len(out), pa.int64()), *[pa.array(x, pa.binary()) for x in data]], names=SUBTREE_NAMES)

    return task


SUBTREE_NAMES = [c.split()[0] for c in SUBTREE_ROWS.split(", ")]


def subtree_of(fits: dict[int, Fit], small: dict[tuple[int, int], dict[int, int]], widths: np.ndarray):
    """Group: the subtree of a small node (block -1), and its values for each block's held-out rows."""
    def grown(key, table):
        number, k, root = (x.as_py() for x in key)
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])  # in order: the sums are the same, whatever came first
        out = {n: [] for n in ("block", "feature", "bin", "left", "value", "held")}

        def add(block, value, held=b"", feature=b"", cut=b"", left=b""):
            for n, x in zip(out, (block, feature, cut, left, value, held)):
                out[n].append(x)

        if root < 0:
            for r in rows:
                add(r["block"], r["value"], r["held"])
        else:
            fit, d = fits[number], len(widths)
            part = lambda n, t: np.frombuffer(b"".join(r[n] for r in rows), t)
            bins, labels, times = part("bins", np.uint8), part("labels", np.int8), part("times", np.uint8).astype(float)
            feature, cut, left, value = subtree(fit, k, root, small[number, k][root], bins.reshape(len(labels), d), labels, times, widths)
            add(-1, value.tobytes(), b"", feature.tobytes(), cut.tobytes(), left.tobytes())
            for r in rows:
                if r["held"]:
                    x = np.frombuffer(r["held_bins"], np.uint8).reshape(len(r["held"]) // 4, d)
                    add(r["block"], value[leaf_of(x, feature, cut, left)].tobytes(), r["held"])
        n = len(out["block"])
        return pa.table([pa.array([number] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array([root] * n, pa.int32()), pa.array(out["block"], pa.int64()),
                         *[pa.array(out[c], pa.binary()) for c in ("feature", "bin", "left", "value", "held")]], names=GROWN_NAMES)

    return grown


def subtree(fit: Fit, tree: int, root: int, level: int, bins: np.ndarray, labels: np.ndarray, times: np.ndarray, widths: np.ndarray):
    """Node arrays of the tree below a node that holds the given rows, grown level by level as
    passes would: all open nodes of a level are split at once. What is added up are whole numbers:
    how often rows of label 1, and all rows, were drawn. A node of one label gains nothing by a split."""
    spec, d = fit.spec, len(widths)
    least, flat = max(spec.min_split, 2 * spec.min_rows), np.ascontiguousarray(bins).ravel()
    x = np.stack([(labels > 0) * times, times]).astype(float)
    feature, cut, left, sums = np.array([-1]), np.array([0]), np.array([0]), x.sum(axis=1)[None]
    rows, opened = np.arange(len(labels)), np.array([0])
    place, first = np.zeros(len(labels), np.int64), np.array([0])  # rows lie in the order of the open nodes
    while len(opened) and len(rows):
        f = tried_by(spec, fit.number, tree, root, opened, d)
        cells, parts, a = np.cumsum(widths[f].sum(axis=1)), [], 0
        while a < len(opened):
            b = max(a + 1, int(np.searchsorted(cells, (cells[a - 1] if a else 0) + CELLS)))
            own = slice(first[a], first[b] if b < len(opened) else len(rows))
            at = place[own] - a
            bin_ = flat[(rows[own] * d)[:, None] + f[a:b][at]]
            parts.append(best_splits_of(spec, fit.weight, x[:, rows[own]], bin_, at, f[a:b], widths))
            a = b
        best, where, lower = (np.concatenate(p) for p in zip(*parts))
        ok = best >= 0
        split = opened[ok]
        feature[split], cut[split], left[split] = best[ok], where[ok], len(feature) + 2 * np.arange(len(split))
        children = np.stack([lower[ok], sums[split] - lower[ok]], axis=1).reshape(-1, 2)
        start = len(feature)
        feature, cut, left = (np.concatenate([c, np.full(len(children), v)]) for c, v in ((feature, -1), (cut, 0), (left, 0)))
        sums = np.concatenate([sums, children])
        level += 1
        more = (children[:, 1] >= least) & (children[:, 0] > 0) & (children[:, 0] < children[:, 1])
        if spec.depth is not None and level >= spec.depth:
            more[:] = False
        child = np.where(ok, 2 * np.cumsum(ok) - 2, -1)[place]
        stay = child >= 0
        rows, place, child = rows[stay], place[stay], child[stay]
        child += flat[rows * d + best[place]] > where[place]
        opened, number = start + np.flatnonzero(more), np.cumsum(more) - 1
        stay = more[child]
        rows, place = rows[stay], number[child[stay]]
        order = np.argsort(place.astype(np.uint16) if len(opened) < 1 << 16 else place, kind="stable")
        rows, place = rows[order], place[order]
        first = np.searchsorted(place, np.arange(len(opened)))
    mass = fit.weight[1] * sums[:, 0], fit.weight[0] * (sums[:, 1] - sums[:, 0])
    value = np.divide(mass[0], mass[0] + mass[1], out=np.zeros(len(sums)), where=mass[0] + mass[1] > 1e-12)
    return feature.astype(np.int16), cut.astype(np.int16), left.astype(np.int32), value


def best_splits_of(spec: TreeSpec, weight: tuple[float, float], x: np.ndarray, bins: np.ndarray, place: np.ndarray, features: np.ndarray, widths: np.ndarray):
    """``best_split`` of many nodes of a forest at once: ``x`` are the draws of label 1 and all draws of rows
    that lie in the nodes ``place`` (each has some), ``bins`` those of the node's ``features``. Only bins
    that hold rows are looked at: a cut at another one is that of the bin before it.
    Returns feature (-1: none), bin and the two numbers of the left child."""
    n, q = features.shape
    ends = np.cumsum(widths[features])
    starts = ends - widths[features].ravel()
    cell = (starts.reshape(n, q)[place] + bins).ravel()
    whole = float(1 << 26)  # both numbers in one sum: a node has fewer draws
    hist = np.bincount(cell, np.repeat(x[0] * whole + x[1], q), int(ends[-1]))
    used = np.flatnonzero(hist)
    ones = np.floor(hist[used] / whole)
    run = np.cumsum(np.stack([ones, hist[used] - ones * whole]), axis=1)
    first = np.searchsorted(used, starts)  # of each feature of a node; each holds some rows
    size = np.diff(first, append=len(used))
    before = np.concatenate([np.zeros((2, 1)), run], axis=1)[:, first]
    left = run - np.repeat(before, size, axis=1)
    all_of = (run[:, first + size - 1] - before)[:, ::q]
    node = np.repeat(np.arange(n), size.reshape(n, q).sum(axis=1))
    right = all_of[:, node] - left

    def masses(s):
        ones = weight[1] * s[0]
        return ones, ones + weight[0] * (s[1] - s[0]), s[1]

    d = 1 if spec.by_hessian else 2

    def score(s):
        return np.divide(s[0] ** 2, s[d] + spec.l2, out=np.zeros_like(s[0]), where=s[d] + spec.l2 > 1e-12)

    lower, upper, both = masses(left), masses(right), score(masses(all_of))
    gain = score(lower) + score(upper) - both[node]
    least = max(1, spec.min_rows)
    gain[(lower[2] < least) | (upper[2] < least) | (lower[1] < spec.min_hessian) | (upper[1] < spec.min_hessian)] = -np.inf
    best = np.maximum.reduceat(gain, first[::q])
    near = np.flatnonzero(gain >= (best * (1 - EQUAL))[node])
    some = (all_of[1] >= spec.min_split) & (best > 1e-10 * np.maximum(1.0, both))
    at = np.where(some, np.append(near, 0)[np.searchsorted(near, first[::q])], 0)
    part = np.searchsorted(first, at, side="right") - 1
    return np.where(some, features.ravel()[part], -1), np.where(some, used[at] - starts[part], 0), left[:, at].T


def forest_predictions(blocks: DataFrame, fits: list[Fit]) -> DataFrame:
    """``predictions`` of forests, from what their trees gave to the held-out rows."""
    of = {f.number: replace(f, done=Trees(), held=None) for f in fits}

    def add(key, table):
        fit, block = (x.as_py() for x in key)
        got = sorted(table.to_pylist(), key=lambda r: r["tree"])
        names = np.unique(np.concatenate([np.frombuffer(r["held"], np.int32) for r in got]))
        total = np.zeros(len(names))
        for r in got:
            total[np.searchsorted(names, np.frombuffer(r["held"], np.int32))] += np.frombuffer(r["value"])
        return pa.table({"fit": pa.array([fit], pa.int32()), "block": pa.array([block], pa.int64()), "held": pa.array([names.astype(np.int32).tobytes()], pa.binary()),
                         "total": pa.array([total.tobytes()], pa.binary())})

    def task(batches):
        for batch in batches:
            ids = batch.column("ids")
            for k, r in enumerate(batch.select(["labels", "fit", "held", "total"]).to_pylist()):
                fit, rows = of[r["fit"]], np.frombuffer(r["held"], np.int32)
                whole = lambda v: pa.array(np.full(len(rows), v, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids[k].values.take(pa.array(rows)), pa.array(np.frombuffer(r["labels"], np.int8)[rows].astype(np.int32)), whole(fit.number),
                     whole(-1 if fit.fold is None else fit.fold), pa.array(np.frombuffer(r["total"]) / fit.spec.trees)], names=["id", "label", "fit", "fold", "probability"])

    sums = (fits[0].held.where((F.col("block") >= 0) & F.col("fit").isin([f.number for f in fits])).select("fit", "tree", "block", "held", "value")
            .groupBy("fit", "block").applyInArrow(add, "fit int, block long, held binary, total binary"))
    return blocks.select("block", "ids", "labels").join(sums, "block").mapInArrow(task, PREDICTED)


PREDICTED = "id string, label int, fit int, fold int, probability double"


def predictions(blocks: DataFrame, fits: list[Fit]) -> DataFrame:
    """(id, label, fit, fold, probability) of the rows held out of each fit: the fold that it
    left out, or the rows of no fold for a fit on all."""
    stored: dict[int, list[Fit]] = {}
    for f in fits:
        if f.held is not None:
            stored.setdefault(id(f.held), []).append(f)
    fits = [f for f in fits if f.held is None]

    def task(batches):
        for batch in batches:
            ids = batch.column("ids")
            for k, b in enumerate(read_blocks([batch])):
                names = ids[k].values
                for fit in fits:
                    rows = np.flatnonzero(b.folds == (-1 if fit.fold is None else fit.fold))
                    p = fit.probability(fit.done.sums(b.bins[rows]))
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(rows)), pa.array(b.labels[rows].astype(np.int32)), pa.array(np.full(len(rows), fit.number, np.int32)),
                         pa.array(np.full(len(rows), -1 if fit.fold is None else fit.fold, np.int32)), pa.array(p)],
                        names=["id", "label", "fit", "fold", "probability"])

    out = blocks.mapInArrow(task, PREDICTED)
    for own in stored.values():
        out = out.unionByName(forest_predictions(blocks, own))
    return out


@dataclass
class TreeModel:
    """A fitted ensemble: scores rows that hold its feature columns."""

    feature_cols: list
    cuts: list
    fit: Fit

    def predict(self, rows: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
        names = [f"f{i}" for i in range(len(self.feature_cols))]
        cuts, fit, keep = self.cuts, replace(self.fit, held=None), list(keep)
        wide = rows.select(F.col(key).alias("id"), *keep, *[F.col(c).cast("double").alias(n) for c, n in zip(self.feature_cols, names)])

        def task(batches):
            for batch in batches:
                if batch.num_rows:
                    p = fit.probability(fit.done.sums(binned(batch, names, cuts)))
                    yield pa.RecordBatch.from_arrays([*batch.select(["id", *keep]).columns, pa.array(p)], names=["id", *keep, "probability"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.select("id", *keep).schema)
        out = wide.mapInArrow(task, f"{kinds}, probability double")
        return out.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

    def save(self, spark, path: str) -> None:
        from ebbflow.sources.io import write_json_row
        t = self.fit.done
        text = json.dumps({"feature_cols": self.feature_cols, "cuts": self.cuts, "spec": asdict(self.fit.spec), "prior": self.fit.prior,
                           "weight": self.fit.weight, "feature": t.feature.tolist(), "bin": t.bin.tolist(), "left": t.left.tolist(),
                           "value": t.value.tolist(), "first": t.first})
        write_json_row(spark.createDataFrame([(text,)], "model string"), path)

    @classmethod
    def load(cls, spark, path: str) -> "TreeModel":
        d = json.loads(spark.read.schema("model string").json(path).first()["model"])
        trees = Trees(np.array(d["feature"], np.int16), np.array(d["bin"], np.int16), np.array(d["left"], np.int32), np.array(d["value"], float), d["first"])
        return cls(d["feature_cols"], d["cuts"], Fit(0, TreeSpec(**d["spec"]), None, d["prior"], tuple(d["weight"]), trees))
