"""SimHash near-duplicates: tiled exact comparison.

A fingerprint holds, for each of 64 bits, whether more than half of the text's word
shingles set it in their XXH64. Fingerprints at ``radius`` or fewer differing bits
link; a document's component is the smallest doc_id that links reach.

Comparison is exact and never pairs documents. Distinct fingerprints only are compared
(copies are one node). Two that differ in at most r bits agree on at least b - r of b
blocks, so fingerprints meet in buckets named by b - r whole blocks; more blocks are used
as the table grows, which changes the cost and not the result. A bucket is ordered by
population count and compared in tiles: numpy exclusive-or and bit counts, where a pair
of tiles whose population counts differ by more than the radius is skipped. A bucket over
``HOT_BUCKET`` is cut into chunks, and each pair of chunks is a task of its own. A tile task
emits a spanning star per local component and not all pairs; components are then joined by
large-star / small-star rounds on the link table, written to the shared folder each round.

Defined results: a text without words (null, empty, spaces) has fingerprint zero and links
like any other; repeated rows share a fingerprint; a null doc_id gets a component only from
others (null if it has none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ebbflow.llm.arrow_text import sliced, text_array
from ebbflow.llm.store import write_once

TILE = 1024
#: Fingerprints of one bucket that one task compares.
HOT_BUCKET = 16_384
#: Expected fingerprints in a bucket of random fingerprints before more blocks are used.
BUCKET_AIM = 4096


def fingerprint_batch(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    hashes: list[np.ndarray] = []
    rows: list[int] = []
    for k, text in enumerate(texts.cast(pa.large_binary())):
        words = text.as_buffer().to_pybytes().lower().split()
        if not words:
            continue
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        n = max(1, len(words) - shingle + 1)
        starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
        stops = ends[-n:].tolist()
        hashes.append(np.fromiter((xxh64_intdigest(flat[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n))
        rows.append(k)
    if not rows:
        return out
    lengths = np.array([len(h) for h in hashes])
    bits = np.unpackbits(np.concatenate(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, np.cumsum(lengths) - lengths, axis=0, dtype=np.int64)
    major = (2 * ones > lengths[:, None]).astype(np.uint8)
    out[rows] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, text_hash (tells rows with one doc_id apart) and fp of every row."""
    def run(batches):
        for part in sliced(batches, most=2 << 20):
            fp = fingerprint_batch(text_array(part.column("text")), shingle, seed)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                                              "fp": pa.array(fp.view(np.int64))})

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def local_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (node, root) of the links between ``a`` and ``b``, compared tile by tile."""
    nodes = np.unique(np.concatenate([a, b]))
    counts = np.bitwise_count(nodes)
    order = np.argsort(counts, kind="stable")
    nodes, counts = nodes[order], counts[order].astype(np.int64)
    in_a, in_b = np.flatnonzero(np.isin(nodes, a)), np.flatnonzero(np.isin(nodes, b))
    label = np.arange(len(nodes))
    for i in range(0, len(in_a), TILE):
        left = in_a[i:i + TILE]
        for j in range(0, len(in_b), TILE):
            right = in_b[j:j + TILE]
            if counts[right[0]] - counts[left[-1]] > radius or counts[left[0]] - counts[right[-1]] > radius:
                continue
            if a is b and right[-1] < left[0]:
                continue
            x, y = np.nonzero(np.bitwise_count(nodes[left][:, None] ^ nodes[right][None, :]) <= radius)
            x, y = left[x], right[y]
            x, y = x[x != y], y[x != y]
            while len(x):
                low = np.minimum(label[x], label[y])
                np.minimum.at(label, label[x], low)
                np.minimum.at(label, label[y], low)
                np.minimum.at(label, x, low)
                np.minimum.at(label, y, low)
                label = label[label]
                if np.array_equal(label[x], label[y]):
                    break
    while not np.array_equal(label, label[label]):
        label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def block_masks(blocks: int, radius: int) -> list[int]:
    """Masks of every choice of ``blocks - radius`` whole blocks of the 64 bits."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, n_nodes: int, radius: int) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of ``nodes.fp`` within ``radius``."""
    blocks = radius + 1
    while blocks < radius + 5 and n_nodes / 2 ** (64 * (blocks - radius) / blocks) > BUCKET_AIM:
        blocks += 1
    choices = [F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
               for k, m in enumerate(block_masks(blocks, radius))]
    entries = nodes.select("fp", F.explode(F.array(*choices)).alias("at")).select("fp", "at.choice", "at.key")
    hot = (entries.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_BUCKET)
           .select("choice", "key", F.ceil(F.col("n") / HOT_BUCKET).cast("int").alias("chunks")))
    entries = entries.join(hot, ["choice", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    entries = (entries.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .select("choice", "key", F.least("c", "other").alias("lo"), F.greatest("c", "other").alias("hi"), "c", "fp"))

    def run(batches):
        def compare(rows: pa.Table):
            c = rows.column("c").to_numpy()
            fp = rows.column("fp").to_numpy().view(np.uint64)
            names = np.column_stack([rows.column(k).to_numpy() for k in ("choice", "key", "lo", "hi")])
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            u, v = [], []
            for s, e in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])):
                if e - s < 2:
                    continue
                lo, hi = names[s][2], names[s][3]
                a = fp[s:e][c[s:e] == lo]
                x, y = local_links(a, a if lo == hi else fp[s:e][c[s:e] == hi], radius)
                u.append(x)
                v.append(y)
            if u:
                yield pa.RecordBatch.from_pydict({"u": pa.array(np.concatenate(u).view(np.int64)),
                                                  "v": pa.array(np.concatenate(v).view(np.int64))})

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            last = rows.slice(rows.num_rows - 1)
            same = pc.and_(pc.equal(rows.column("choice"), last.column("choice")[0]),
                           pc.equal(rows.column("key"), last.column("key")[0]))
            same = pc.and_(same, pc.and_(pc.equal(rows.column("lo"), last.column("lo")[0]),
                                         pc.equal(rows.column("hi"), last.column("hi")[0])))
            begin = rows.num_rows - int(pc.sum(same.cast(pa.int64())).as_py())
            if begin:
                yield from compare(rows.slice(0, begin).combine_chunks())
            held = rows.slice(begin)
        if held is not None:
            yield from compare(held.combine_chunks())

    names = ["choice", "key", "lo", "hi"]
    return entries.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every linked node: large-star and small-star rounds until nothing changes."""
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(low, "u")
        if large:
            return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return moved.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = write_once(edges.where("u <> v").distinct(), "links")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = write_once(star(star(edges, True), False), "links")
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def classes(docs: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, text_hash, fp and component_id (smallest doc_id reachable) of every row."""
    rows = write_once(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    n_nodes = rows.agg(F.approx_count_distinct("fp")).first()[0]
    roots = components(links(nodes, n_nodes, radius))
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """One row of each component: that of the smallest doc_id. Among rows with this
    doc_id the smallest by text hash stays, and of rows equal in both the first by the JSON form
    of their other columns, which may have any type (maps too). Rows without a doc_id stay, as
    nothing names them."""
    rows = write_once(classes(docs, shingle, radius, seed).where("doc_id is not null"), "classes")
    best = rows.where("doc_id = component_id").groupBy("doc_id").agg(
        F.min("text_hash").alias("text_hash"), F.count("*").alias("n"))
    gone = rows.join(best, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text_hash").distinct()
    again = best.where("n > 1").select("doc_id", "text_hash")
    # Both joins use one key, a struct that is never null, so they share one shuffle of docs.
    key = "k" * (1 + max(map(len, docs.columns)))  # no column of docs has this name
    named = docs.withColumn(key, F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t")))

    def keys(df: DataFrame) -> DataFrame:
        return df.select(F.struct(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).alias(key))

    once = named.join(keys(gone.union(again)), key, "left_anti")
    rest = [n for n in docs.columns if n != "doc_id"]
    many = named.join(keys(again), key, "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*rest), F.to_json(F.struct(F.lit(0).alias(key), *[n for n in rest if n != "text"]))).alias(key))
    many = many.select("doc_id", *[F.col(key)[n].alias(n) for n in rest])
    return once.select(*docs.columns).unionByName(many.select(*docs.columns))
