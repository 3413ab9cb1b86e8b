"""Approximate nearest neighbours with balanced posting lists.

Nearness is the largest inner product. One further coordinate, sqrt(M**2 - |x|**2) for the
largest norm M (0 for a query), turns it into the smallest distance.

* Centroids come from a bounded sample (``SAMPLE`` rows, at most ``SAMPLE_MB``) by repeated
  balanced splitting: a k-means step in which crowded centroids cost more.
* The centroids form an in-memory graph: each is linked to its nearest ones, both ways. A
  search walks the graph from a few entry points and goes on wherever a centroid is within the
  wanted distance ratio of the nearest one found, or among the ``BEAM`` nearest.
* Each row goes to the list of its nearest centroid, and a boundary row also to the next lists
  within ``BOUNDARY`` times that distance (``COPIES`` lists at most).
* A query reads the lists whose centroid is within ``ratio`` times its nearest centroid's
  distance, and more if those cannot hold its neighbours. ``fit`` takes the smallest ratio that finds ``recall`` of the sample's true
  neighbours.
* Lists are stored by segment of about ``SEGMENT`` rows: several small lists, or a part of a
  large one, so a list that a hot vector fills is spread over many. Queries meet the segments
  of their lists in groups of about ``QUERIES``; in a task rows stream list by list past the
  queries that chose the list, and a running selection keeps the best. Scores are recomputed
  by one fixed order of summation, so equal vectors have equal scores.

Every row is indexed. The model (at most ``LISTS`` centroids) is what reaches the driver and
every task; its size does not depend on the number of rows beyond that.

Defined results: rows with a null id, null, zero, or non-finite vectors take no part, nor do
vectors of another length than the most common one; a row is no neighbour of itself, but
repeated rows are rows of their own; fewer rows than asked are all returned; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow.llm.store import write_once
from ebbflow.llm.vectors import CHUNK, binary, common_length, first_k, matrix, usable

SAMPLE, SAMPLE_MB = 65_536, 32
#: Rows a list should hold, and lists at most.
LIST_ROWS, LISTS = 256, 4096
#: Graph: links of a centroid, entry points, candidates kept open at least.
LINKS, ENTRIES, BEAM = 16, 16, 8
BOUNDARY, COPIES = 1.015, 2
SEGMENT, QUERIES = 65_536, 4096
#: Queries of the sample that set the ratio.
TRIALS = 256

ROW_SCHEMA = "row long, vec_id long, vec binary"
FOUND = "query long, vec_id long, row long, score double"


def vector_rows(embeddings: DataFrame, length: int) -> DataFrame:
    """A written table of the rows that take part: row number, vec_id, vector as doubles."""
    def run(batches):
        for batch in batches:
            values = np.asarray(batch.column("embedding").flatten(), np.float64).reshape(-1, length)
            keep = (values != 0).any(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(keep)), binary(values[keep])], names=["vec_id", "vec"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") == length) & F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    return write_once(rows.mapInArrow(run, "vec_id long, vec binary").withColumn("row", F.monotonically_increasing_id()), "vector-rows")


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``."""
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1))


def split(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 16) -> np.ndarray:
    """A class for each row: ``k`` classes of similar size, by k-means whose distances carry a
    price that rises for classes above the mean size and falls for those below. Prices move by
    a part of what tells the classes apart, less in each round."""
    centres = x[rng.choice(len(x), k, replace=False)]
    price, to = np.zeros(k), np.zeros(len(x), np.int64)
    for n in range(rounds):
        d = squared(x, centres)
        to = np.argmin(d + price, axis=1)
        size = np.bincount(to, minlength=k)
        price += (d.mean(axis=1) - d.min(axis=1)).mean() * (size * k / len(x) - 1) / (2 + n)
        for j in np.flatnonzero(size):
            centres[j] = x[to == j].mean(axis=0)
    return to


def balanced_centroids(x: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    """About ``k`` centroids (k >= 1), neighbours next to each other, by splitting the largest
    parts into up to 8."""
    rng = np.random.default_rng(seed)

    def parts(x: np.ndarray, k: int):
        if k <= 1 or len(x) < 2 * k or (x == x[0]).all():
            return [x.mean(axis=0)]
        n = min(8, k)
        to = split(x, n, rng)
        out = []
        for j in np.unique(to):
            own = x[to == j]
            out += parts(own, max(1, round(k * len(own) / len(x)))) if len(own) < len(x) else [own.mean(axis=0)]
        return out

    return np.array(parts(x, k))


@dataclass
class Index:
    """Centroids with their graph, and what turns inner products into distances."""

    centroids: np.ndarray
    links: np.ndarray
    most: float
    ratio: float = 1.0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.most**2 - (x * x).sum(1)))
        return np.hstack([x, rest[:, None]])

    def search(self, x: np.ndarray, ratio: float, least: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, distance) of the centroids within ``ratio`` times the nearest one's
        distance, for lifted rows; found by walking the graph."""
        n = len(self.centroids)
        d = np.full((len(x), n), np.inf)
        done = np.zeros((len(x), n), bool)
        entry = np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64))
        d[:, entry] = np.sqrt(squared(x, self.centroids[entry]))
        least = min(least, n)
        while True:
            near = np.partition(d, least - 1, axis=1)[:, least - 1]
            reach = np.maximum(near, ratio * d.min(axis=1))  # there are at least BEAM entry points
            row, at = np.nonzero((d <= reach[:, None]) & ~done)
            if not len(row):
                break
            done[row, at] = True
            new = np.unique((row[:, None] * n + self.links[at]).ravel())
            new = new[np.isinf(d.ravel()[new])]
            for a in range(0, len(new), 1 << 16):
                r, c = np.divmod(new[a:a + (1 << 16)], n)
                d[r, c] = np.sqrt(((x[r] - self.centroids[c]) ** 2).sum(1))
        row, at = np.nonzero(d <= ratio * d.min(axis=1, keepdims=True) * (1 + 1e-12))
        return row, at, d[row, at]

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for every list that a row goes to."""
        row, at, d = self.search(self.lifted(x), BOUNDARY)
        order = np.lexsort((at, d, row))
        row, at = row[order], at[order]
        near = np.arange(len(row)) - np.searchsorted(row, row) < COPIES
        return row[near], at[near]

    def lists_for(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) for every list that a query reads: those within the ratio, and while they
        hold fewer than ``least`` entries the next nearest ones."""
        x = np.hstack([x, np.zeros((len(x), 1))])
        row, at, _ = self.search(x, self.ratio)
        held = np.bincount(row, sizes[at], minlength=len(x))
        few = np.flatnonzero(held < least)
        order = np.argsort(squared(x[few], self.centroids), axis=1, kind="stable")
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        more, place = np.nonzero(before < least)
        keep = ~np.isin(row, few)
        return np.concatenate([row[keep], few[more]]), np.concatenate([at[keep], order[more, place]])


def graph(centroids: np.ndarray) -> np.ndarray:
    """Links of every centroid: its nearest ones, the ones that it is nearest to (as many as
    fit), and both neighbours in the order of splitting, which keep the graph connected."""
    n = len(centroids)
    links = np.repeat(np.arange(n)[:, None], 2 * LINKS + 2, axis=1)
    near = np.empty((n, min(LINKS, n)), np.int64)
    for a in range(0, n, 512):
        near[a:a + 512] = np.argsort(squared(centroids[a:a + 512], centroids), axis=1)[:, 1:LINKS + 1] if n > LINKS else np.arange(n)
    links[:, : near.shape[1]] = near
    back = np.zeros(n, np.int64)
    for i, j in zip(np.repeat(np.arange(n), near.shape[1]), near.ravel()):
        if back[j] < LINKS:
            links[j, LINKS + back[j]] = i
            back[j] += 1
    links[1:, -1], links[:-1, -2] = np.arange(n - 1), np.arange(1, n)
    return links


def fit(rows: DataFrame, length: int, k: int, recall: float = 0.95) -> Index | None:
    """Index fitted on the rows with the smallest hashes."""
    total = rows.count()
    if not total:
        return None
    size = int(min(SAMPLE, max(1024, SAMPLE_MB * (1 << 20) // (8 * length))))
    # Rows beyond 1.3 times the expected share of the hashes are not needed; all pass while few.
    h = F.xxhash64("row", "vec_id")
    share = F.pmod(h, F.lit(1 << 30)) < int(min(1.0, (1.3 * size + 1000) / total) * (1 << 30))
    sample = rows.where(share).orderBy(h, "row").limit(size).select("vec").toArrow()
    x = matrix(sample.column("vec").combine_chunks(), "<f8", length)
    most = rows.mapInArrow(largest_norm(length), "norm double").agg(F.max("norm")).first()[0]
    index = Index(np.zeros((1, length + 1)), np.zeros((1, 1), np.int64), most)
    lists = min(LISTS, max(1, round(total / LIST_ROWS)), max(1, len(x) // 16))
    index.centroids = balanced_centroids(index.lifted(x), lists)
    index.links = graph(index.centroids)
    index.ratio = needed_ratio(index, x, k, recall)
    return index


def largest_norm(length: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"norm": [float(np.sqrt((matrix(batch.column("vec"), "<f8", length) ** 2).sum(1).max()))]})

    return run


def needed_ratio(index: Index, x: np.ndarray, k: int, recall: float) -> float:
    """The smallest distance ratio at which ``recall`` of the true neighbours of the first
    rows of a sample lie in a list that is read."""
    q = x[:TRIALS]
    score = q @ x.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return 1.0
    true = np.argpartition(-score, k - 1, axis=1)[:, :k]
    wanted = np.unique(true)
    row, at = index.lists_of(x[wanted])
    d = np.sqrt(squared(np.hstack([q, np.zeros((len(q), 1))]), index.centroids))
    d = np.maximum(d, 1e-300) / np.maximum(d.min(axis=1, keepdims=True), 1e-300)
    needed = np.full((len(q), len(wanted)), np.inf)
    for r, c in zip(row, at):
        np.minimum(needed[:, r], d[:, c], out=needed[:, r])
    needed = np.sort(np.take_along_axis(needed, np.searchsorted(wanted, true), axis=1).ravel())
    return float(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) * (1 + 1e-9)


def postings(rows: DataFrame, index: Index, length: int) -> DataFrame:
    """A written table: every row once in each of its lists."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                row, at = index.lists_of(matrix(part.column("vec"), "<f8", length))
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *part.columns], names=["list", *part.schema.names])

    return write_once(rows.select("row", "vec_id", "vec").mapInArrow(run, f"list int, {ROW_SCHEMA}"), "postings")


def segments(sizes: dict[int, int], most: int) -> dict[int, tuple[int, int]]:
    """First segment and number of segments of every list: neighbouring lists share a segment
    while they fit, a larger list has several of its own."""
    out, segment, held = {}, 0, 0
    for name in sorted(sizes):
        n = sizes[name]
        if held and held + n > most:
            segment, held = segment + 1, 0
        parts = math.ceil(n / most)
        out[name] = (segment, parts)
        if parts > 1:
            segment, held = segment + parts, 0
        else:
            held += n
    return out


def neighbours(embeddings: DataFrame, query: Column, k: int = 20, recall: float = 0.95) -> DataFrame:
    """The ``k`` nearest rows found for every row of ``embeddings`` (vec_id, embedding) that
    satisfies ``query`` (a condition on vec_id): query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    embeddings = usable(embeddings)
    length = common_length(embeddings)
    rows = vector_rows(embeddings, length)
    index = fit(rows, length, k, recall)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stored = postings(rows, index, length)
    sizes = {r["list"]: r["count"] for r in stored.groupBy("list").count().collect()}  # at most LISTS rows
    asked = rows.where(query)
    groups = max(1, math.ceil(asked.count() / QUERIES))
    cores = spark.sparkContext.defaultParallelism
    total = sum(sizes.values())
    layout = segments(sizes, max(1, min(SEGMENT, max(math.ceil(total / (2 * cores)), 4 * LIST_ROWS))))
    place = spark.createDataFrame([(name, *where) for name, where in layout.items()], "list int, segment int, parts int")

    held = np.array([sizes.get(c, 0) for c in range(len(index.centroids))])

    def choose(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                row, at = index.lists_for(matrix(part.column("vec"), "<f8", length), held, (k + 1) * COPIES)
                wanted = [(r, s, c) for r, c in zip(row.tolist(), at.tolist()) if c in layout
                          for s in range(layout[c][0], sum(layout[c]))]
                by = {}
                for r, s, c in wanted:
                    by.setdefault((r, s), []).append(c)
                out = part.take(pa.array([r for r, _ in by], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([s for _, s in by], pa.int32()), pa.array(list(by.values()), pa.list_(pa.int32())), *out.columns],
                                                 names=["segment", "lists", *out.schema.names])

    deal = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int").alias("group")
    left = (asked.select("row", "vec_id", "vec").mapInArrow(choose, f"segment int, lists array<int>, {ROW_SCHEMA}")
            .select("segment", deal, F.lit(-1).alias("list"), "lists", "row", "vec_id", "vec"))
    right = stored.join(F.broadcast(place), "list").select(  # one row a list, at most LISTS
        (F.col("segment") + F.pmod(F.xxhash64("row", F.lit(2)), F.col("parts")).cast("int")).alias("segment"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "list", F.lit(None).cast("array<int>").alias("lists"), "row", "vec_id", "vec")
    parts = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (left.unionByName(right).repartition(parts, "segment", "group").sortWithinPartitions("segment", "group", "list", "vec_id")
             .mapInArrow(scan(length, k), FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    # Copies of a row in several lists are equal in all three and share a rank.
    best = found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates(["query", "rank"])
    names = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")


def scan(length: int, k: int):
    """Task: streams sorted (segment, group, list) rows, queries (list -1) first."""
    def run(batches):
        key, queries, asked, held, size = None, [], None, [], 0

        def merged():
            q, vec_id, row, score = (np.concatenate(x) for x in zip(*held))
            at = first_k(q, score, vec_id, k, row)
            return q[at], vec_id[at], row[at], score[at]

        def flush():
            if held:
                q, vec_id, row, score = merged()
                yield pa.RecordBatch.from_arrays([pa.array(asked["row"][q]), pa.array(vec_id), pa.array(row), pa.array(score)],
                                                 names=["query", "vec_id", "row", "score"])

        for batch in batches:
            group = np.asarray(batch.column("segment"), np.int64) << 32 | np.asarray(batch.column("group"), np.int64)
            lists = np.asarray(batch.column("list"), np.int64)
            cuts = np.flatnonzero((np.diff(group) != 0) | (np.diff(lists) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                if stop == start:
                    continue
                if group[start] != key:
                    yield from flush()
                    key, queries, asked, held, size = group[start], [], None, [], 0
                piece = batch.slice(start, stop - start)
                if lists[start] < 0:
                    queries.append(piece)
                    continue
                asked = asked or questions(queries, length)
                mine = asked["of"].get(int(lists[start]))
                if mine is None:
                    continue
                for a in range(0, piece.num_rows, CHUNK):
                    got = nearest_in(asked, mine, piece.slice(a, CHUNK), length, k)
                    held.append(got)
                    size += len(got[0])
                    if size > 1 << 20:
                        held = [merged()]
                        size = len(held[0][0])
        yield from flush()

    return run


def questions(pieces: list, length: int) -> dict:
    """Row numbers and vectors of a group's queries, and the queries of every list."""
    if not pieces:
        return {"of": {}}
    table = pa.Table.from_batches(pieces).combine_chunks()
    of: dict[int, list[int]] = {}
    for q, lists in enumerate(table.column("lists").to_pylist()):
        for name in lists:
            of.setdefault(name, []).append(q)
    return {"row": np.asarray(table.column("row"), np.int64), "vec": matrix(table.column("vec").combine_chunks(), "<f8", length),
            "of": {name: np.array(x) for name, x in of.items()}}


def nearest_in(asked: dict, mine: np.ndarray, piece, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(query, vec_id, row, score) of the ``k`` nearest rows of a piece for the given queries."""
    x = matrix(piece.column("vec"), "<f8", length)
    vec_id, row = np.asarray(piece.column("vec_id"), np.int64), np.asarray(piece.column("row"), np.int64)
    # Of equal vectors only the k + 1 with the smallest ids can be among the nearest.
    equal = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * 8}").ravel(), return_inverse=True)[1]
    if equal.max(initial=-1) + 1 < len(x):
        at = np.sort(first_k(equal, np.zeros(len(x)), vec_id, k + 1))
        x, vec_id, row = x[at], vec_id[at], row[at]
    q = asked["vec"][mine]
    score = q @ x.T
    score[asked["row"][mine][:, None] == row] = -np.inf
    if len(row) > k:
        slack = 1e-12 * np.abs(q).sum(1) * np.abs(x).max()
        least = np.partition(score, len(row) - k, axis=1)[:, len(row) - k] - slack
        i, j = np.nonzero((score >= least[:, None]) & np.isfinite(score))
    else:
        i, j = np.nonzero(np.isfinite(score))
    exact = np.concatenate([(q[i[a:a + CHUNK * 16]] * x[j[a:a + CHUNK * 16]]).sum(1) for a in range(0, len(i), CHUNK * 16)] or [np.zeros(0)])
    at = first_k(i, exact, vec_id[j], k)
    return mine[i[at]], vec_id[j[at]], row[j[at]], exact[at]
