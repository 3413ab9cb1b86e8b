"""Token-ID binary output: patched frame-of-reference blocks.

Documents are encoded where they lie; their ids, as 16-bit numbers if the vocabulary allows it,
go to the range of doc_ids that they belong to (the texts do not move), are sorted there, and
each range is written as a sequence of segments. The ranges' limits come from a bounded sample
of the sort keys. A segment is a self-contained binary image:

    "PFR2" | u32 n_ids | u32 n_docs | u32 block_size | u32 n_blocks | u32 n_names | u32 u32 (0)
    u32 names[n_names]: the segment's distinct ids, most frequent first (none: ids are stored as they are)
    u32 byte offset of every block, counted from the first block (the index)
    u8 has_id[n_docs] | i64 doc_id[n_docs] | u32 n_tokens[n_docs]
    blocks, each: u32 minimum | u8 width | u8 bytes of an exception | u16 n_exceptions
                  | values minus minimum, width bits each, padded to a byte
                  | positions[n_exceptions] | values minus minimum[n_exceptions]

Values are places in ``names``, which makes frequent ids small, or the ids themselves where
that is smaller. ``width`` holds one of the ``PERCENTILES`` of a block's values, the one that
makes the block smallest; values that need more bits are exceptions, packed as zero, their
positions in 8 bits (16 in blocks of over 256) and their values in 16 bits where they fit. The
index lets a reader decode one block alone. Images are the ``image`` column of a Parquet table
in the shared folder, so Spark's committer makes the output whole when tasks are retried, on
any store Spark can write.

Segments end at document borders after ``SEGMENT_IDS`` ids, so a task holds one segment
(or one document) at a time. Defined results: a null text is empty and has the end id
alone; rows with equal doc_id stand in order of their texts' first ``PREFIX`` characters, then
of a hash of the text; a null doc_id comes first; an empty table gives a table without
segments; other columns are ignored.
"""

from __future__ import annotations

import struct
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ebbflow.llm.arrow_text import sliced, text_array
from ebbflow.llm.store import fresh_path
from ebbflow.llm.tokens import SLICE_BYTES, shared_encoder, tokenizer_path

MAGIC = b"PFR2"
HEADER = 32
SEGMENT_IDS = 1 << 18
BLOCK_SIZE = 256
PERCENTILES = (50, 60, 70, 80, 90, 95, 100)
PREFIX = 32
#: Sampled sort keys for each range.
SAMPLED = 64
SEGMENT_SCHEMA = "shard int, segment int, first_id long, n_ids long, n_docs long, image binary"
IDS_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


#: Bits needed for each 16-bit value (0 for 0).
BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def bit_width(values: np.ndarray) -> np.ndarray:
    """Bits needed for each unsigned value of up to 32 bits (0 for 0)."""
    if values.size and values.max() < 1 << 16:
        return BITS[values]
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned values as rows of bytes, ``width`` bits each, low bit first."""
    size = 16 if width <= 16 else 32
    bits = np.unpackbits(values.astype(f"<u{size // 8}").view(np.uint8), axis=1, bitorder="little")
    return np.packbits(bits.reshape(len(values), -1, size)[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def unpack_bits(rows: np.ndarray, width: int, n: int) -> np.ndarray:
    size = 16 if width <= 16 else 32
    bits = np.zeros((len(rows), n, size), np.uint8)
    bits[:, :, :width] = np.unpackbits(rows, axis=1, count=n * width, bitorder="little").reshape(len(rows), n, width)
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view(f"<u{size // 8}")


def widths_of(rest: np.ndarray, percentiles, place: int) -> tuple[np.ndarray, int]:
    """The width of each row of values (its minimum taken off) that makes the block smallest, and
    the bits of all blocks together; ``place`` is the bytes of a position."""
    need = bit_width(rest)
    n, top = rest.shape[1], int(need.max(initial=0))
    value = np.where(need.max(axis=1) > 16, 32, 16) + 8 * place
    within = np.stack([(need <= w).sum(axis=1) for w in range(top + 1)], axis=1)  # values that fit, by width
    best, width = None, None
    for p in percentiles:
        w = (within <= min(n - 1, int(n * p / 100))).sum(axis=1)
        cost = w * n + (n - within[np.arange(len(w)), w]) * value
        better = np.ones(len(w), bool) if best is None else cost < best
        best = cost if best is None else np.where(better, cost, best)
        width = w if width is None else np.where(better, w, width)
    return width, int(best.sum()) if best is not None else 0


def tables_of(values: np.ndarray, block_size: int) -> list[tuple[int, np.ndarray]]:
    """(first block, rows of values) of the whole blocks and of the short last one."""
    whole = len(values) // block_size
    found = [(0, values[: whole * block_size].reshape(whole, block_size)), (whole, values[whole * block_size:].reshape(1, -1))]
    return [(first, t) for first, t in found if t.size]


def encode_blocks(values: np.ndarray, block_size: int, percentiles) -> list[bytes]:
    """Blocks of consecutive values; the last may be short."""
    blocks: list[bytes] = [b""] * -(-len(values) // block_size)
    place = 1 if block_size <= 256 else 2
    for first, table in tables_of(values, block_size):
        low = table.min(axis=1)
        rest = (table - low[:, None]).astype(np.uint32)
        widths, _ = widths_of(rest, percentiles, place)
        for w in np.unique(widths):
            at = np.flatnonzero(widths == w)
            part = rest[at]
            odd = part >> np.uint32(w) > 0 if w < 32 else np.zeros(part.shape, bool)
            packed = pack_bits(np.where(odd, 0, part).astype(np.uint32), int(w))
            n_odd = odd.sum(axis=1)
            ends = np.cumsum(n_odd)
            where, kept = np.nonzero(odd)[1].astype(f"<u{place}"), part[odd]
            size = np.where(np.where(odd, part, 0).max(axis=1) > 65535, 4, 2)
            for k, row in enumerate(at):
                a, b = ends[k] - n_odd[k], ends[k]
                blocks[first + row] = (struct.pack("<IBBH", int(low[row]), int(w), int(size[k]), b - a) + packed[k].tobytes()
                                       + where[a:b].tobytes() + kept[a:b].astype(f"<u{size[k]}").tobytes())
    return blocks


def renamed(ids: np.ndarray, block_size: int, percentiles) -> tuple[np.ndarray, np.ndarray]:
    """The ids' places among the distinct ids, most frequent first, and those ids; or the ids
    themselves and no names, if that is smaller."""
    if ids.max(initial=0) < 1 << 16:
        count = np.bincount(ids)
        names = np.flatnonzero(count)
        names = names[np.argsort(-count[names], kind="stable")]
        rank = np.zeros(len(count), np.int64)
        rank[names] = np.arange(len(names))
        ranked = rank[ids]
    else:
        names, which, count = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.argsort(order, kind="stable")
        names, ranked = names[order], rank[which]

    def bits(values):
        return sum(widths_of((t - t.min(axis=1, keepdims=True)).astype(np.uint32), percentiles, 1 if block_size <= 256 else 2)[1]
                   for _, t in tables_of(values, block_size))

    return (ranked, names) if len(ids) and 32 * len(names) + bits(ranked) < bits(ids) else (ids, names[:0])


def encode_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray,
                   block_size: int = BLOCK_SIZE, percentiles=PERCENTILES) -> bytes:
    values, names = renamed(np.asarray(ids, np.int64), block_size, percentiles)
    blocks = encode_blocks(values, block_size, percentiles)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])[:-1]]) if blocks else np.zeros(0)
    known = np.array([i is not None for i in doc_ids], np.uint8)
    named = np.array([0 if i is None else i for i in doc_ids], "<i8")
    return b"".join([MAGIC, struct.pack("<IIIIIII", len(ids), len(doc_ids), block_size, len(blocks), len(names), 0, 0), names.astype("<u4").tobytes(),
                     starts.astype("<u4").tobytes(), known.tobytes(), named.tobytes(), np.asarray(lengths, "<u4").tobytes(), *blocks])


class Segment:
    """Reader of one image: its documents, and the ids of any block."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.bytes = np.frombuffer(image, np.uint8)
        self.n_ids, self.n_docs, self.block_size, self.n_blocks, n_names = struct.unpack_from("<IIIII", image, 4)
        at = HEADER
        self.names = np.frombuffer(image, "<u4", n_names, at)
        at += 4 * n_names
        self.block_starts = np.frombuffer(image, "<u4", self.n_blocks, at)
        at += 4 * self.n_blocks
        known = np.frombuffer(image, np.uint8, self.n_docs, at)
        at += self.n_docs
        named = np.frombuffer(image, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.doc_ids = [int(i) if k else None for i, k in zip(named, known)]
        self.lengths = np.frombuffer(image, "<u4", self.n_docs, at).astype(np.int64)
        self.blocks_at = at + 4 * self.n_docs
        self.place = 1 if self.block_size <= 256 else 2

    def numbers(self, at: np.ndarray, size: int) -> np.ndarray:
        """Little-endian numbers of ``size`` bytes at the given places."""
        return self.bytes[at[:, None] + np.arange(size)].astype(np.int64) @ (np.int64(1) << (8 * np.arange(size, dtype=np.int64)))

    def blocks(self, first: int, stop: int) -> np.ndarray:
        """Ids of the blocks [first, stop); blocks of one width are decoded together."""
        at = self.blocks_at + self.block_starts[first:stop].astype(np.int64)
        n = np.minimum(self.block_size, self.n_ids - np.arange(first, stop) * self.block_size)
        low, width, size, n_odd = (self.numbers(at + o, k) for o, k in ((0, 4), (4, 1), (5, 1), (6, 2)))
        out = np.zeros((stop - first, self.block_size), np.int64)
        for w, m in sorted(set(zip(width.tolist(), n.tolist()))):
            rows = np.flatnonzero((width == w) & (n == m))
            packed = self.bytes[(at[rows] + 8)[:, None] + np.arange(-(-m * w // 8))]
            out[rows, :m] = unpack_bits(packed, w, m)
        after = at + 8 + -(-n * width // 8)
        for k in (2, 4):
            rows = np.flatnonzero((n_odd > 0) & (size == k))
            row = np.repeat(rows, n_odd[rows])
            i = np.arange(len(row)) - np.repeat(np.cumsum(n_odd[rows]) - n_odd[rows], n_odd[rows])
            where = self.numbers(after[row] + i * self.place, self.place)
            out[row, where] = self.numbers(after[row] + n_odd[row] * self.place + i * k, k)
        out += low[:, None]
        flat = out.ravel()[: int(n.sum())]
        return self.names[flat] if len(self.names) else flat.astype(np.uint32)

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids [first, stop) of the segment; only the blocks that hold them are decoded."""
        stop = self.n_ids if stop is None else stop
        if stop <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block_size, -(-stop // self.block_size)
        return self.blocks(a, b)[first - a * self.block_size: stop - a * self.block_size]


def ranges(keys: DataFrame, n: int) -> list[tuple]:
    """Limits of up to ``n`` ranges of about equally many rows of (doc_id, prefix, hash), from
    about ``SAMPLED`` sampled keys a range."""
    total = keys.count()
    sample = keys.sample(min(1.0, SAMPLED * n / max(1, total)), 42) if total > SAMPLED * n else keys
    found = sorted(map(sort_key, *zip(*sample.collect()))) if total else []
    return sorted(set(found[len(found) * k // n] for k in range(1, n))) if found else []


def sort_key(doc_id, prefix, h) -> tuple:
    return (doc_id is not None, doc_id or 0, prefix is not None, prefix or "", h)


def write(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", kind: str = "word", end_id: int = 1,
          block_size: int = BLOCK_SIZE, percentiles=PERCENTILES, path: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) and write the segments; returns the table's path."""
    vocabulary = tokenizer_path(tokenizer)
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.substring("text", 1, PREFIX).alias("prefix"),
                        F.xxhash64("text").alias("h"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = ranges(keyed.drop("text"), parts)

    def encode(batches):
        encoder = None
        for part in sliced(batches, most=SLICE_BYTES):
            encoder = encoder or shared_encoder(vocabulary, kind)
            ids, at = encoder.encode(text_array(part.column("text")))
            doc, prefix, h = (part.column(c) for c in ("doc_id", "prefix", "h"))
            keys = map(sort_key, doc.to_pylist(), prefix.to_pylist(), h.to_pylist())
            shard = pa.array([bisect_right(limits, k) for k in keys], pa.int32())
            size = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
            flat = np.asarray(ids).astype(f"<u{size}").tobytes()
            coded = pa.array([flat[size * a:size * b] for a, b in zip(at[:-1], at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([shard, doc, prefix, h, pa.array(np.full(len(shard), size, np.int8)), coded],
                                             names=["shard", "doc_id", "prefix", "h", "size", "ids"])

    def pack(batches):
        shard, segment, done = None, 0, 0
        held_docs: list = []
        held_ids: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal segment, done, held, held_docs, held_ids
            lengths = np.array([len(x) for x in held_ids])
            row = {"shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()),
                   "first_id": [done], "n_ids": [held], "n_docs": [len(held_docs)],
                   "image": pa.array([encode_segment(held_docs, lengths, np.concatenate(held_ids), block_size,
                                                     percentiles)], pa.binary())}
            segment, done, held, held_docs, held_ids = segment + 1, done + held, 0, [], []
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for own, doc_id, size, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "size", "ids"))):
                if own != shard:
                    if held_docs:
                        yield flush()
                    shard, segment, done = own, 0, 0
                held_docs.append(doc_id)
                held_ids.append(np.append(np.frombuffer(ids, f"<u{size}").astype(np.int64), end_id))
                held += len(held_ids[-1])
                if held >= SEGMENT_IDS:
                    yield flush()
        if held_docs:
            yield flush()

    path = path or fresh_path(spark, "tokens")
    (keyed.mapInArrow(encode, "shard int, doc_id long, prefix string, h long, size byte, ids binary")
     .repartitionById(parts, F.col("shard"))
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), F.col("prefix").asc_nulls_first(), "h")
     .mapInArrow(pack, SEGMENT_SCHEMA).write.parquet(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a written table: doc_id, start (ids of all documents before it),
    n_tokens, and its ids as little-endian unsigned 32-bit integers."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One row per range, of which there are as many as shuffle partitions: the images stay where they are.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids_in_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("ids_in_shard").over(before), F.lit(0)).alias("shard_first"))

    def run(batches):
        for batch in batches:
            for first, image in zip(batch.column("at").to_pylist(), batch.column("image")):
                seg = Segment(image.as_buffer().to_pybytes())
                ids = seg.ids().astype("<u4").tobytes()
                ends = np.cumsum(seg.lengths)
                starts = ends - seg.lengths
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(seg.doc_ids, pa.int64()), "start": pa.array(first + starts),
                    "n_tokens": pa.array(seg.lengths),
                    "ids": pa.array([ids[4 * a:4 * b] for a, b in zip(starts, ends)], pa.binary())})

    return (segments.join(F.broadcast(shards), "shard")
            .select((F.col("shard_first") + F.col("first_id")).alias("at"), "image").mapInArrow(run, IDS_SCHEMA))
