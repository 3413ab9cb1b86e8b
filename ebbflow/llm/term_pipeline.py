"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to ``OWNERS`` owners by their hash. Documents are read once: each task packs
``BLOCK`` documents at a time into one record of document lengths and, for every owner, one
record of postings (term, document, count) of the terms that some item asks for. A bitmap of
fixed size over the items' term hashes keeps other terms in the task; the postings carry the
terms themselves, so nothing rests on a hash. Counts of all documents, terms and documents
holding a term come from the same records.

Items travel in bundles of about ``BUNDLE``. For each block of documents a bundle starts
with empty accumulators and goes through the owners in turn: a cogroup meets it with that
owner's postings of the block and the weights of the bundle's terms there (broadcast up to
``BROADCAST_TERMS``, shuffled beyond), and adds the
integer contributions to its sparse accumulators (only documents with a score are kept). After
the last owner the ``k`` best of each item and block remain, and a ranked window over the
blocks gives the answer. A group is one bundle and one block, bounded by BUNDLE x BLOCK
accumulators however common a term or a document is.

Defined results: null and empty texts hold no terms, match nothing and are matched by nothing;
a null doc_id stands before all others among equal scores; rows of either table that repeat
are rows of their own; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from ebbflow.llm.arrow_text import SLICE_BYTES, flat_bytes, sliced, text_array, words
from ebbflow.llm.store import write_once
from ebbflow.llm.template_windows import BITMAP_BITS, bitmap_of
from ebbflow.llm.vectors import first_k

OWNERS = 4
#: Documents of a block and postings after which a block is closed; items of a bundle.
BLOCK, POSTINGS = 4096, 2_000_000
BUNDLE = 128
#: Terms of items (a few dozen bytes each) that are broadcast at most.
BROADCAST_TERMS = 100_000

#: What each byte of a text becomes: separators a space, A-Z lower case, all others themselves.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)

BLOCK_SCHEMA = ("block long, owner int, doc_ids array<long>, lengths binary, n_docs long, n_terms long, "
                "terms array<string>, counts binary, docs binary, tfs binary")
ACCUMULATORS = "bundle int, block long, doc_ids array<long>, lengths binary, items binary, docs binary, scores binary"
FOUND = "item long, doc_id long, score long"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, flat, and the offsets of the texts in them."""
    data, offsets = flat_bytes(texts.cast(pa.large_string()))
    folded = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(FOLD[data])])
    return words(folded)


def item_terms(items: DataFrame) -> DataFrame:
    """A written table (item, term, times): the terms of each item row, numbered by row."""
    def run(batches):
        for part in sliced(batches):
            flat, at = terms_of(text_array(part.column("text")))
            item = np.repeat(np.asarray(part.column("item"), np.int64), np.diff(at))
            yield pa.RecordBatch.from_arrays([pa.array(item), flat.cast(pa.string())], names=["item", "term"])

    flat = items.select("item", "text").mapInArrow(run, "item long, term string")
    return write_once(flat.groupBy("item", "term").agg(F.count("*").alias("times")), "item-terms")


def document_blocks(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Records of ``BLOCK_SCHEMA``: owner -1 holds a block's documents, the others postings."""
    def run(batches):
        block = TaskContext.get().partitionId() << 32
        held = Held(bitmap)
        for part in sliced(batches, most=SLICE_BYTES):
            for a in range(0, part.num_rows, BLOCK):
                piece = part.slice(a, BLOCK)
                if held.n + piece.num_rows > BLOCK or held.size > POSTINGS:
                    yield held.record(block)
                    block, held = block + 1, Held(bitmap)
                held.add(piece.column("doc_id"), text_array(piece.column("text")))
        if held.n:
            yield held.record(block)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, BLOCK_SCHEMA)


class Held:
    """Documents and postings of the block being filled."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.n, self.size = bitmap, 0, 0
        self.names: dict[str, int] = {}
        self.doc_ids, self.lengths, self.found = [], [], []

    def add(self, doc_ids: pa.Array, texts: pa.Array) -> None:
        flat, at = terms_of(texts)
        coded = flat.dictionary_encode()
        named = np.full(len(coded.dictionary), -1, np.int64)
        for k, term in enumerate(coded.dictionary.to_pylist()):
            place = xxh64_intdigest(term.encode(), 42) >> (64 - BITMAP_BITS)
            if self.bitmap[place >> 3] >> (place & 7) & 1:
                named[k] = self.names.setdefault(term, len(self.names))
        which = named[coded.indices.to_numpy(zero_copy_only=False)]
        doc = np.repeat(np.arange(len(texts)), np.diff(at))[which >= 0]
        pair, tf = np.unique(which[which >= 0] << 32 | doc, return_counts=True)
        self.found.append((pair >> 32, (pair & 0xFFFFFFFF) + self.n, tf))
        self.size += len(pair)
        self.doc_ids.append(doc_ids)
        self.lengths.append(np.diff(at))
        self.n += len(texts)

    def record(self, block: int) -> pa.RecordBatch:
        lengths = np.concatenate(self.lengths)
        term, doc, tf = (np.concatenate(x) for x in zip(*self.found))
        names = list(self.names)
        owner = np.array([xxh64_intdigest(x.encode(), 42) % OWNERS for x in names], np.int64)
        rows = [{"block": block, "owner": -1, "doc_ids": pa.concat_arrays(self.doc_ids).to_pylist(), "lengths": lengths.astype("<i8").tobytes(),
                 "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum())}]
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        for o in range(OWNERS):
            own = np.flatnonzero(owner == o)
            at = np.isin(term, own)
            rows.append({"block": block, "owner": o, "terms": [names[k] for k in own],
                         "counts": np.bincount(np.searchsorted(own, term[at]), minlength=len(own)).astype("<i4").tobytes(),
                         "docs": doc[at].astype("<i4").tobytes(), "tfs": tf[at].astype("<i4").tobytes()})
        return pa.RecordBatch.from_pylist(rows, schema=RECORD)


RECORD = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()),
                    ("n_terms", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary())])


def document_frequencies(blocks: DataFrame) -> DataFrame:
    """(term, df): documents that hold each term of the postings."""
    def run(batches):
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(np.frombuffer(counts, "<i4").astype(np.int64))], names=["term", "n"])

    return blocks.where("owner >= 0").select("terms", "counts").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))


def stage(n_docs: int, n_terms: int, last: int | None):
    """Cogroup step: adds one owner's contributions to a bundle's accumulators in a block. The
    last one gives the ``last`` best documents of every item instead."""
    def run(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        doc_ids = bundle.column("doc_ids").chunk(0)[0].values
        lengths = np.frombuffer(bundle.column("lengths")[0].as_py(), "<i8")
        items = np.frombuffer(bundle.column("items")[0].as_py() or b"", "<i8")
        asked = postings.column("asked")[0].as_py() if postings.num_rows else []
        names = np.unique(np.concatenate([items, [x["item"] for x in asked]]).astype(np.int64))
        total = np.zeros((len(names), len(lengths)), np.int64)
        held = np.frombuffer(bundle.column("docs")[0].as_py() or b"", "<i4")
        total[np.searchsorted(names, items), held] = np.frombuffer(bundle.column("scores")[0].as_py() or b"", "<i8")
        if asked:
            base = 25 + (75 * lengths * n_docs) // max(1, n_terms)
            counts = np.frombuffer(postings.column("counts")[0].as_py(), "<i4")
            docs, tfs = (np.frombuffer(postings.column(c)[0].as_py(), "<i4") for c in ("docs", "tfs"))
            ends = np.cumsum(counts)
            place = {t: k for k, t in enumerate(postings.column("terms")[0].as_py())}
            rows = np.searchsorted(names, [x["item"] for x in asked])
            share: dict[int, np.ndarray] = {}
            for x, row in zip(asked, rows):
                k = place.get(x["term"])
                if k is None:
                    continue
                d = docs[ends[k] - counts[k]:ends[k]]
                if k not in share:
                    tf = tfs[ends[k] - counts[k]:ends[k]].astype(np.int64)
                    share[k] = x["weight"] * ((1_000_000_000 * tf) // (1000 * tf + 8 * base[d]))
                total[row, d] += x["times"] * share[k]
        row, doc = np.nonzero(total)
        score = total[row, doc]
        if last is None:
            return pa.table([[key[0].as_py()], [key[1].as_py()], pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())), pa.array([lengths.tobytes()], pa.binary()),
                             pa.array([names[row].astype("<i8").tobytes()], pa.binary()), pa.array([doc.astype("<i4").tobytes()], pa.binary()),
                             pa.array([score.astype("<i8").tobytes()], pa.binary())], schema=CARRIED)
        ids = np.asarray(doc_ids.fill_null(np.iinfo(np.int64).min), np.int64)
        at = first_k(row, score, ids[doc], last)
        return pa.table([pa.array(names[row[at]]), doc_ids.take(pa.array(doc[at])), pa.array(score[at])], names=["item", "doc_id", "score"])

    return run


CARRIED = pa.schema([("bundle", pa.int32()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("items", pa.binary()),
                     ("docs", pa.binary()), ("scores", pa.binary())])


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents (doc_id, text) for every item (item_id, text), by integer
    scores: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = write_once(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = item_terms(rows)
    blocks = write_once(document_blocks(docs, bitmap_of(terms.select(F.xxhash64("term").alias("hash")))), "term-blocks")
    n_docs, n_terms = (x or 0 for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    bundles = max(1, math.ceil(rows.count() / BUNDLE))

    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle")
    owner = F.conv(F.hex(F.xxhash64("term")), 16, 10).cast("decimal(20,0)") % OWNERS
    asked = (terms.join(document_frequencies(blocks), "term")
             .select(bundle, owner.cast("int").alias("owner"), F.struct("item", "term", "times", weight.alias("weight")).alias("x"))
             .groupBy("bundle", "owner").agg(F.collect_list("x").alias("asked")))
    asked = write_once(asked, "bundle-terms")
    small = (asked.agg(F.sum(F.size("asked"))).first()[0] or 0) <= BROADCAST_TERMS
    # Beyond that bound the terms go to every copy of their owner, so an owner's postings need not meet in one task.
    copies = 1 if small else int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = F.broadcast(asked) if small else asked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).hint("merge")

    none = F.lit(None).cast("binary")
    carried = blocks.where("owner = -1").select(F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"), "block", "doc_ids", "lengths",
                                                none.alias("items"), none.alias("docs"), none.alias("scores"))
    for o in range(OWNERS):
        postings = blocks.where(F.col("owner") == o).select("block", "owner", "terms", "counts", "docs", "tfs",
                                                            F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy"))
        postings = postings.join(asked, ["owner"] if small else ["owner", "copy"]).drop("copy", "owner")
        postings = postings.toDF(*postings.columns)  # columns of its own beside the accumulators'
        step = stage(n_docs, n_terms, k if o == OWNERS - 1 else None)
        carried = (carried.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block"))
                   .applyInArrow(step, FOUND if o == OWNERS - 1 else ACCUMULATORS))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = carried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
