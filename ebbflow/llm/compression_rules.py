"""Quality rules: compression bands.

A text is compressed whole, and in fixed chunks that reach its last byte, with zstandard.
Repetitive text
compresses far better than prose, random or encoded text far worse, and both
depend on the length, so each length band has limits of its own.

One pass over the documents inside ``mapInArrow``; no shuffle, and memory bounded
by ``SLICE_BYTES`` of text (or one document) per task.

Defined results: null and empty texts have no words, fail the base rules and are
rejected; repeated rows are judged one by one; further columns pass through
``keep_good`` untouched; empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ebbflow.llm.arrow_text import IS_SPACE, flat_bytes, mix64, per_row, sliced, text_array, words

SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

RULE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "n_bytes long, ratio double, n_chunks long, n_bad_chunks long, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Bands:
    """Limits of the rules. ``upto[i]`` bytes (exclusive) end band i; a whole text of that
    length must have a compression ratio in [lo[i], hi[i]]; the last band is open. Prose of
    many languages lies between 1.4 (half a kilobyte) and 3 (whole books); frame overhead
    keeps short texts near 1, so the shortest have no lower limit."""

    upto: tuple[int, ...] = (128, 256, 512, 1024, 2048, 4096, 16384, 65536)
    lo: tuple[float, ...] = (0.0, 1.0, 1.1, 1.2, 1.3, 1.4, 1.45, 1.5, 1.5)
    hi: tuple[float, ...] = (2.0, 2.6, 2.6, 2.7, 2.9, 3.1, 3.4, 3.6, 4.0)
    chunk: int = 2048
    chunk_lo: float = 1.4
    chunk_hi: float = 3.2
    # Texts under ``chunk`` bytes but of ``short_from`` are cut finer, with limits of their own.
    short_from: int = 1024
    short_chunk: int = 512
    short_lo: float = 1.25
    short_hi: float = 2.7
    bad_chunk_share: float = 0.1
    level: int = 3
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5


def repeated_words(ids: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Words lying in a window of ``window`` word ids that occurs at least twice in its
    text, the first occurrence included. Windows are compared by a 64-bit hash."""
    n = len(ids)
    count = np.zeros(len(offsets) - 1, np.int64)
    if n < window:
        return count
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    spread = mix64(ids.astype(np.uint64))
    key = mix64(doc[: n - window + 1].astype(np.uint64) + np.uint64(1 << 40))
    for k in range(window):
        key = mix64(key) + spread[k: n - window + 1 + k] * np.uint64(2 * k + 0x9E3779B1)
    inside = np.flatnonzero(doc[: n - window + 1] == doc[window - 1:])
    key = key[inside]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, inside[twice], 1)
    np.add.at(edge, inside[twice] + window, -1)
    return per_row(np.cumsum(edge)[:n] > 0, offsets)


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    lists = pc.split_pattern(texts, "\n")
    offsets = np.asarray(lists.offsets, np.int64)
    lines = lists.values
    wordy = np.asarray(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False))
    ids = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = (doc * (len(ids) + 1) + ids)[wordy]
    firsts = np.unique(keys) // (len(ids) + 1)
    return per_row(wordy, offsets) - np.bincount(firsts, minlength=len(texts))


def in_band(ratio: float, n_bytes: int, bands: Bands) -> bool:
    k = bisect_right(bands.upto, n_bytes)
    return bands.lo[k] <= ratio <= bands.hi[k]


def compression(raw: bytes, compressor, bands: Bands) -> tuple[float, int, int]:
    """(ratio of the whole text, number of chunks, chunks outside their limits). Texts are cut
    into chunks of ``chunk`` bytes, shorter ones of ``short_chunk``; the last chunk is the last
    bytes of the text, so every byte is judged. A text under ``short_from`` is one chunk with
    the limits of its length band."""
    if not raw:
        return 0.0, 0, 0
    ratio = len(raw) / len(compressor.compress(raw))
    if len(raw) < min(bands.short_from, bands.chunk):
        return ratio, 1, int(not in_band(ratio, len(raw), bands))
    long = len(raw) >= bands.chunk
    size, lo, hi = (bands.chunk, bands.chunk_lo, bands.chunk_hi) if long else (bands.short_chunk, bands.short_lo, bands.short_hi)
    starts = [*range(0, len(raw) - size + 1, size)]
    if len(raw) % size:
        starts.append(len(raw) - size)
    bad = sum(not lo <= size / len(compressor.compress(raw[k:k + size])) <= hi for k in starts)
    return ratio, len(starts), bad


def judge(column, bands: Bands) -> dict[str, np.ndarray]:
    """All counts, ratios and verdicts for one Arrow column of texts."""
    import zstandard

    texts = text_array(column)
    data, byte_at = flat_bytes(texts)
    flat, word_at = words(texts)
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    out = {"n_words": np.diff(word_at),
           "word_chars": per_row(((data & 0xC0) != 0x80) & ~IS_SPACE[data], byte_at),
           "n_symbols": per_row(IS_SYMBOL[data], byte_at),
           "n_dup_lines": duplicate_lines(texts),
           "n_repeat_words": repeated_words(ids, word_at, bands.window),
           "n_bytes": np.diff(byte_at)}
    compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
    raw = data.tobytes()
    found = [compression(raw[a:b], compressor, bands) for a, b in zip(byte_at[:-1], byte_at[1:])]
    out["ratio"], out["n_chunks"], out["n_bad_chunks"] = (np.array(x) for x in zip(*found))
    band = np.searchsorted(np.array(bands.upto), out["n_bytes"], side="right")
    whole = (out["ratio"] >= np.array(bands.lo)[band]) & (out["ratio"] <= np.array(bands.hi)[band])
    chunks = out["n_bad_chunks"] <= bands.bad_chunk_share * out["n_chunks"]
    out["base_failed"] = ((out["n_words"] < bands.min_words)
                          | (100 * out["n_repeat_words"] > bands.max_repeat_percent * out["n_words"]))
    out["kept"] = ~out["base_failed"] & whole & chunks
    return out


def score(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id and every count, ratio and verdict of each row of ``docs`` (doc_id, text)."""
    def run(batches):
        for part in sliced(batches):
            found = judge(part.column("text"), bands)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | {k: pa.array(v) for k, v in found.items()})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {RULE_SCHEMA}")


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` whose verdict is ``kept``, with all their columns."""
    def run(batches):
        for part in sliced(batches):
            yield part.filter(pa.array(judge(part.column("text"), bands)["kept"]))

    return docs.mapInArrow(run, docs.schema)
