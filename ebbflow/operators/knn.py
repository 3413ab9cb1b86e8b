"""Exact k-nearest-neighbour vote (uniform or 1/distance weights,
euclidean or manhattan), over a metric index.

Pivots are a seeded sample of the references (at most ``PIVOTS``). Each reference is filed
under its nearest pivot with its distance to it; a pivot's references are cut into rings by
that distance. Rows lie in blocks of at most about ``block_rows``: a larger ring is cut by a
hash, so copies of one point are spread; smaller rings of near pivots share a block. The directory (pivot, ring, smallest and largest distance, rows) has at
most ``PIVOTS`` x ``RINGS`` entries, whatever the number of references.

For every ring the triangle inequality gives a lower bound on the distance of a query to its
members: from the pivot's distance and the ring's limits, and from the fact that a member is
no nearer to any other pivot than to its own. A first pass visits the rings with the smallest
bounds until they hold ``k`` references; the k-th distance found there is an upper limit. A
second pass visits only the rings whose bound does not exceed it. The result is exact.

A query goes once to each block that holds a ring it visits, so it is copied at most as often
as there are blocks, and a reference as often as there are groups of queries.
A visit is one ``cogroup`` of a block with a group of the queries that asked for it. Squared
euclidean distances come from one matrix product; those that its rounding error leaves in
question are computed exactly. It emits each query's local top-k within its limit, and a window ranks the candidates by (distance, id). How much is skipped depends on the data:
clustered or low-dimensional vectors skip most rings, independent coordinates in many
dimensions none (``visited_share`` tells); then the work is every distance once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.session import at_once, materialize

#: Bytes of the difference array (queries x references x dimensions) computed at once in a task.
CELL_BYTES = 128 << 20

#: Bytes of a product of queries and references, which stays in a core's cache; pairs ranked at once.
PRODUCT_BYTES, PAIRS = 2 << 20, 1 << 18

#: Pivots at most, references for which one more pivot is taken, rings of a pivot at most.
PIVOTS, PIVOT_ROWS, RINGS = 1024, 256, 64

#: References of a block: as many as make ``BLOCKS`` blocks, within these limits, and its bytes at most. Queries of a group at most.
BLOCKS, BLOCK_LIMITS, BLOCK_BYTES, GROUP_ROWS = 32, (4096, 32_768), 64 << 20, 32_768

#: Bounds are relaxed by this share, so that rounding never skips a neighbour.
SLACK = 1e-9


def _exact(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray, metric: str) -> np.ndarray:
    """Distances of pairs of rows."""
    out, step = np.empty(len(row)), max(1, CELL_BYTES // (8 * max(1, a.shape[1])))
    for s in range(0, len(row), step):
        diff = a[row[s:s + step]] - b[col[s:s + step]]
        out[s:s + step] = np.sqrt((diff * diff).sum(axis=1)) if metric == "euclidean" else np.abs(diff).sum(axis=1)
    return out


def _near(qv: np.ndarray, tv: np.ndarray, upper: np.ndarray | None, k: int, metric: str):
    """For some queries at a time, the (query, reference) pairs that may be among the ``k`` nearest and within
    ``upper``: all that are, and those that rounding leaves in question."""
    flat, d = metric == "euclidean", qv.shape[1]
    qq, tt = (qv * qv).sum(axis=1), (tv * tv).sum(axis=1)
    if flat:  # one product gives the squared distances
        qa, ta = np.column_stack([-2 * qv, qq, np.ones(len(qv))]), np.column_stack([tv, np.ones(len(tv)), tt]).T
    step = max(1, PRODUCT_BYTES // (8 * len(tv)) if flat else CELL_BYTES // (8 * len(tv) * max(1, d)))
    for s in range(0, len(qv), step):
        rows = slice(s, min(s + step, len(qv)))
        # Squared distances (or the distances), and how far rounding may take them.
        if flat:
            far = qa[rows] @ ta
            slack = 1e-14 * (d + 8) * (qq[rows] + tt.max())
        else:
            far = np.abs(qv[rows, None, :] - tv[None, :, :]).sum(axis=2)
            slack = 1e-14 * (d + 8) * far.max(axis=1)
        if upper is None:
            limit = np.partition(far, k - 1, axis=1)[:, k - 1]
        else:
            limit = upper[rows] ** 2 * (1 + SLACK) if flat else upper[rows] * (1 + SLACK)
        row, col = np.divmod(np.flatnonzero(far <= (limit + 2 * slack)[:, None]), len(tv))
        if upper is not None:
            many = np.flatnonzero(np.bincount(row, minlength=len(far)) > 4 * k)
            if len(many):
                limit[many] = np.minimum(limit[many], np.partition(far[many], k - 1, axis=1)[:, k - 1])
                near = far[row, col] <= (limit + 2 * slack)[row]
                row, col = row[near], col[near]
        yield row + s, col


def _cell_topk(k: int, metric: str):
    def fn(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        if not (q.empty or t.empty):
            qv = np.stack(q["vec"].to_numpy()).astype(np.float64)
            tv = np.stack(t["vec"].to_numpy()).astype(np.float64)
            place = np.unique(t["id"].to_numpy(), return_inverse=True)[1]  # ids in order, of any type
            held, n = [], 0

            def rank():
                row, col = (np.concatenate(x) for x in zip(*held))
                held.clear()
                d = _exact(qv, tv, row, col, metric)
                order = np.lexsort((place[col], d, row))
                row, col, d = row[order], col[order], d[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                found.append((row[keep], col[keep], d[keep]))

            for pairs in _near(qv, tv, q["upper"].to_numpy(float) if "upper" in q else None, min(k, len(tv)), metric):
                held.append(pairs)
                n += len(pairs[0])
                if n > PAIRS:
                    rank()
                    n = 0
            if held:
                rank()
        row, col, dist = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"qid": q["id"].to_numpy()[row], "nid": t["id"].to_numpy()[col],
                             "nlabel": t["label"].to_numpy()[col].astype(np.int32), "dist": dist})
    return fn


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances of the rows of ``a`` and ``b``."""
    if metric == "euclidean":
        return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)))
    return np.stack([np.abs(a - x).sum(1) for x in b], axis=1)


@dataclass
class MetricIndex:
    """Pivots and the directory of their rings: what tasks need to know."""

    pivots: np.ndarray
    metric: str
    edges: list[np.ndarray]      # inner limits between a pivot's rings
    pivot: np.ndarray            # per ring: its pivot, limits, rows, first block and number of blocks
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    first: np.ndarray
    blocks: np.ndarray

    def ring_of(self, pivot: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """Position in the directory of the ring that holds a reference."""
        start = np.searchsorted(self.pivot, np.arange(len(self.pivots)))
        out = np.empty(len(pivot), np.int64)
        for p in np.unique(pivot):
            at = pivot == p
            out[at] = start[p] + np.searchsorted(self.edges[p], dist[at], side="left")
        return out

    def pack(self, block_rows: int) -> None:
        """Give the rings their blocks: rings of near pivots share one until it is full."""
        rank = np.empty(len(self.pivots), np.int64)
        rank[spatial_order(self.pivots)] = np.arange(len(self.pivots))
        self.first, self.blocks = np.zeros(len(self.size), np.int64), np.maximum(1, -(-self.size // block_rows))
        block, held = 0, 0
        for r in np.argsort(rank[self.pivot], kind="stable"):
            if held and held + self.size[r] > block_rows:
                block, held = block + 1, 0
            self.first[r] = block
            held += self.size[r]
            if held > block_rows:
                block, held = block + self.blocks[r], 0

    def blocks_of(self, rings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, block) of the blocks that hold the rings marked in each row, each once."""
        row, ring = np.nonzero(rings & (self.size > 0))
        times = self.blocks[ring]
        row, ring = np.repeat(row, times), np.repeat(ring, times)
        block = self.first[ring] + np.arange(len(ring)) - np.repeat(np.cumsum(times) - times, times)
        width = int((self.first + self.blocks).max(initial=1))
        return np.divmod(np.unique(row * width + block), width)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """A lower bound on the distance of every query to the members of every ring."""
        if not len(self.pivots):
            return np.zeros((len(queries), 0))
        d = distances(queries, self.pivots, self.metric)
        to = d[:, self.pivot]
        other = (to - d.min(axis=1, keepdims=True)) / 2
        bound = np.maximum(np.maximum(self.low - to, to - self.high), other)
        # distances come from rounded products: allow for the size of the numbers, too
        scale = np.abs(queries).max(axis=1, initial=0)[:, None] + np.abs(self.pivots).max(initial=0)
        return bound * (1 - SLACK) - 1e-7 * scale * max(1, queries.shape[1]) ** 0.5


def spatial_order(points: np.ndarray) -> np.ndarray:
    """Positions of points such that near ones follow each other: halves by the widest coordinate."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) < 3:
            out.extend(own)
            continue
        x = points[own]
        own = own[np.argsort(x[:, np.ptp(x, axis=0).argmax()], kind="stable")] if x.shape[1] else own
        todo += [own[len(own) // 2:], own[:len(own) // 2]]
    return np.array(out, np.int64)


def build_index(train: DataFrame, n_train: int, metric: str, block_rows: int | None, seed: int = 42) -> tuple[MetricIndex, DataFrame]:
    """Index over ``train`` (id, vec, label), and the filed rows (id, vec, label, pivot, dist)."""
    want = min(PIVOTS, max(1, math.ceil(n_train / PIVOT_ROWS)))
    h = F.xxhash64("id", F.lit(seed))
    share = F.pmod(h, F.lit(1 << 30)) < int(min(1.0, (1.5 * want + 100) / max(1, n_train)) * (1 << 30))
    sample = [r["vec"] for r in train.where(share).select("id", "vec", h.alias("_h")).orderBy("_h", "id").limit(want).collect()]
    pivots = np.unique(np.array(sample, np.float64), axis=0) if sample else np.zeros((0, 0))
    block_rows = block_rows or max(1, min(max(BLOCK_LIMITS[0], min(BLOCK_LIMITS[1], n_train // BLOCKS)), BLOCK_BYTES // (8 * max(1, pivots.shape[1]))))

    def file(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("vec").flatten(), np.float64).reshape(batch.num_rows, -1)
                d = distances(x, pivots, metric)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])],
                                                 names=[*batch.schema.names, "pivot", "dist"])

    kind = train.schema["id"].dataType.simpleString()
    rows = materialize(train.select("id", "vec", "label").mapInArrow(file, f"id {kind}, vec array<double>, label int, pivot int, dist double"), "metric-index")
    cuts = rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        "dist", F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)]), F.lit(10_000)).alias("q")).collect()  # one row a pivot
    edges = [np.zeros(0)] * len(pivots)
    for r in cuts:
        rings = min(RINGS, max(1, math.ceil(r["n"] / block_rows)))
        edges[r["pivot"]] = np.unique([r["q"][round(i * RINGS / rings) - 1] for i in range(1, rings)])
    index = MetricIndex(pivots, metric, edges, *[np.zeros(0)] * 6)
    index.pivot = np.repeat(np.arange(len(pivots)), [len(e) + 1 for e in edges])

    def measure(batches):
        for batch in batches:
            d = np.asarray(batch.column("dist"))
            yield pa.RecordBatch.from_arrays([pa.array(index.ring_of(np.asarray(batch.column("pivot")), d)), pa.array(d)], names=["ring", "dist"])

    found = (rows.select("pivot", "dist").mapInArrow(measure, "ring long, dist double").groupBy("ring")
             .agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect())  # one row a ring
    n = len(index.pivot)
    index.low, index.high, index.size = np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n, np.int64)
    for r in found:
        index.low[r["ring"]], index.high[r["ring"]], index.size[r["ring"]] = r["low"], r["high"], r["n"]
    index.pack(block_rows)
    return index, rows


def _visits(index: MetricIndex, rows: DataFrame, queries: DataFrame, k: int, limited: bool, n_queries: int, block_rows: int | None) -> DataFrame:
    """The local top-k of every block that a query visits: those of the first rings that hold ``k``
    references, or with ``limited`` all others with a ring whose bound is within the query's ``upper``."""
    groups = max(1, math.ceil(n_queries / (block_rows or GROUP_ROWS)))
    limit = ["upper"] * limited

    def choose(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("vec").flatten(), np.float64).reshape(batch.num_rows, -1)
            for start in range(0, len(x), 256):
                bound = index.bounds(x[start:start + 256])
                bound[:, index.size == 0] = np.inf
                order = np.argsort(bound, axis=1, kind="stable")
                held = np.cumsum(index.size[order], axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, (held - index.size[order] < k) & (index.size[order] > 0), axis=1)
                row, block = index.blocks_of(first)
                if limited:
                    upper = np.asarray(batch.column("upper").slice(start, 256), np.float64)
                    seen = row, block
                    row, block = index.blocks_of(bound <= upper[:, None])
                    new = ~np.isin(row * (1 << 40) + block, seen[0] * (1 << 40) + seen[1])
                    row, block = row[new], block[new]
                part = batch.select(["id", "vec", *limit]).slice(start, 256).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(block)], names=["id", "vec", *limit, "block"])

    def place(batches):
        for batch in batches:
            ring = index.ring_of(np.asarray(batch.column("pivot")), np.asarray(batch.column("dist")))
            block = index.first[ring] + np.asarray(batch.column("h"), np.int64) % index.blocks[ring]
            yield pa.RecordBatch.from_arrays([*batch.select(["id", "vec", "label"]).columns, pa.array(block)], names=["id", "vec", "label", "block"])

    kind, own = (df.schema["id"].dataType.simpleString() for df in (queries, rows))
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group")
    te = queries.mapInArrow(choose, f"id {kind}, vec array<double>, {'upper double, ' * limited}block long").select("*", group)
    tr = (rows.select("id", "vec", "label", "pivot", "dist", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("h"))
          .mapInArrow(place, f"id {own}, vec array<double>, label int, block long"))
    # Only the groups that ask for a block get a copy of it.
    tr = tr.join(te.select("block", "group").distinct(), "block").toDF("block", "id", "vec", "label", "group")
    return te.groupBy("block", "group").cogroup(tr.groupBy("block", "group")).applyInPandas(
        _cell_topk(k, index.metric), f"qid {kind}, nid {own}, nlabel int, dist double")


def neighbours(train: DataFrame, test: DataFrame, k: int = 11, metric: str = "euclidean",
               id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               block_rows: int | None = None, n_train: int | None = None, n_test: int | None = None) -> DataFrame:
    """(qid, nid, nlabel, dist, rank) for the k nearest references of every query. ``id_col``
    tells rows apart and has any type; equal distances rank by it.
    ``block_rows`` (by default as many as suit the table) bounds the rows of a block and of a group of queries.
    ``n_train`` / ``n_test`` (row counts, when known) size the index without a count job."""
    n_train = train.count() if n_train is None else n_train
    n_test = test.count() if n_test is None else n_test
    vec = F.col(vec_col).cast("array<double>").alias("vec")
    index, rows = build_index(train.select(F.col(id_col).alias("id"), vec, F.col(label_col).cast("int").alias("label")), n_train, metric, block_rows)
    queries = test.select(F.col(id_col).alias("id"), vec)
    w = Window.partitionBy("qid").orderBy("dist", "nid")
    near = _visits(index, rows, queries, k, False, n_test, block_rows)
    near = materialize(near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank"), "nearest-rings")
    upper = near.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(float("inf")).alias("upper"))
    queries = queries.join(upper, F.col("id") == F.col("qid")).drop("qid")
    far = _visits(index, rows, queries, k, True, n_test, block_rows)
    return near.unionByName(far).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def visited_share(train: DataFrame, test: DataFrame, k: int = 11, metric: str = "euclidean", id_col: str = "vec_id",
                  vec_col: str = "embedding", label_col: str = "label", block_rows: int | None = None) -> float:
    """The share of all (query, reference) distances that ``neighbours`` computes."""
    n_train, n_test = train.count(), test.count()
    vec = F.col(vec_col).cast("array<double>").alias("vec")
    index, _ = build_index(train.select(F.col(id_col).alias("id"), vec, F.col(label_col).cast("int").alias("label")), n_train, metric, block_rows)
    last = neighbours(train, test, k, metric, id_col, vec_col, label_col, block_rows, n_train, n_test).where(F.col("rank") == k)
    queries = test.select(F.col(id_col).alias("id"), vec).join(last.select(F.col("qid").alias("id"), "dist"), "id", "left")

    inside = np.zeros(int((index.first + index.blocks).max(initial=0)))  # rows of the blocks
    for first, times, size in zip(index.first, index.blocks, index.size):
        inside[first:first + times] += size / times

    def visited(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("vec").flatten(), np.float64).reshape(batch.num_rows, -1)
                upper = np.asarray(batch.column("dist").fill_null(np.inf))
                yield pa.RecordBatch.from_pydict({"n": [float(inside[index.blocks_of(index.bounds(x) <= upper[:, None])[1]].sum())]})

    return (queries.mapInArrow(visited, "n double").agg(F.sum("n")).first()[0] or 0.0) / max(1, n_train * n_test)


def vote(nbrs: DataFrame, weights: str = "distance") -> DataFrame:
    """Weighted vote per query: uniform, or 1/distance where an exact match
    (distance 0) takes all the weight. The highest total wins; on a tie the
    smallest label (the reference's argmax over sorted classes)."""
    if weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid")) == 1
        w = F.when(has_zero, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    per = nbrs.withColumn("w", w).groupBy("qid", "nlabel").agg(F.sum("w").alias("score"),
                                                              F.count(F.lit(1)).alias("votes"))
    best = per.groupBy("qid").agg(F.min(F.struct((-F.col("score")).alias("neg"), F.col("nlabel"),
                                                 F.col("votes"))).alias("b"),
                                  F.sum("score").alias("total"))
    return best.select(F.col("qid"), F.col("b.nlabel").alias("predicted"), F.col("b.votes").alias("votes"),
                       (-F.col("b.neg") / F.col("total")).alias("vote_share"))


def knn_classify(train: DataFrame, test: DataFrame, k: int = 11, weights: str = "distance",
                 metric: str = "euclidean", **kw) -> DataFrame:
    return vote(neighbours(train, test, k, metric, **kw), weights)


def vote_proba(nbrs: DataFrame, k: int, weights: str = "distance", positive: int = 1) -> DataFrame:
    """P(positive) per query from its ``k`` nearest (``rank <= k``): the weighted
    share of positive neighbours (exact matches take all the weight)."""
    top = nbrs.where(F.col("rank") <= k)
    if weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid")) == 1
        w = F.when(has_zero, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    top = top.withColumn("w", w)
    return top.groupBy("qid").agg(
        (F.sum(F.when(F.col("nlabel") == positive, F.col("w")).otherwise(0.0)) / F.sum("w")).alias("probability"))


def knn_grid_cv(train: DataFrame, ks=(5, 7, 11), weights=("uniform", "distance"), metrics=("euclidean", "manhattan"),
                fold: str = "fold", n_folds: int = 5, **kw) -> DataFrame:
    """M11 + M12 for the KNN family: per (k, weights, metric) the per-fold
    predictions of the held-out fold. Neighbours are found once per (fold, metric)
    at the largest k; every (k, weights) is voted from them."""
    kmax = max(ks)
    # fold sizes from one job: they size every cell without per-search counts
    per_fold = {r[fold]: r["n"] for r in train.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(per_fold.values())

    def search(m, f):
        tr, te = train.where(F.col(fold) != f), train.where(F.col(fold) == f)
        nb = neighbours(tr, te, k=kmax, metric=m, n_train=total - per_fold.get(f, 0),
                        n_test=per_fold.get(f, 0), **kw)
        nb = materialize(nb, "neighbours")  # read once per configuration
        labels = te.select(F.col(kw.get("id_col", "vec_id")).alias("qid"),
                           F.col(kw.get("label_col", "label")).cast("int").alias("label"))
        return [vote_proba(nb, k, w).join(labels, "qid").select(
            F.lit(f"k={k},weights={w},metric={m}").alias("config"), F.lit(f).alias("fold"), "qid", "label", "probability")
            for k in ks for w in weights]

    # the folds' searches do not need each other: their small jobs fill the cores together
    parts = [p for m in metrics for found in at_once(train.sparkSession, [lambda m=m, f=f: search(m, f) for f in range(n_folds)]) for p in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
