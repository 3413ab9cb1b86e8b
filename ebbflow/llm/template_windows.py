"""Benchmark decontamination: template canonicalisation.

Words lose their outer punctuation and case; numbers, names and units become typed
placeholders, so a question with other numbers or names has the same template. A name is a run
of capitalised words and one placeholder. Case alone does not tell a name from the start of
a sentence, so documents are read three ways (every capitalised word a name, none, those
inside sentences) and every capitalised word of an item both ways. Windows of
``WINDOW`` template words (``SHORT_WINDOW`` in items of less than ``LONG_ITEM`` words, the whole
template of a still shorter one) are hashed and hash-joined between documents and benchmark
items. Matches on neighbouring diagonals (distances between
document and item, at most ``GAP`` words apart) are one candidate copy, so words put in, left
out or replaced do not split it. It counts if it covers ``COVERAGE`` of the item's words or
``RUN`` consecutive ones, and its slots are consistent: equal slot values of the item always
stand for equal values in the document, and the other way round. A diagonal whose own slots
contradict each other only counts for ``RUN`` consecutive words with equal slots; where only
names contradict, matches with other names are left out, like replaced words. A name at the
edge of a window may run on in the document, so it is not compared there. All slots
equal: a verbatim copy, else a re-parameterised one.

Documents are read once. A bitmap of fixed size over the benchmark's window hashes lets
only windows that may match leave the task, so what is shuffled follows the matches and
not the corpus, and the join checks full hashes whatever the benchmark's size.

Defined results: null and empty texts match nothing; items with fewer than ``SHORTEST``
words, or without a window of ``MIN_WORDS`` plain words, cannot be told from chance and
match nothing; repeated rows give one row per doc_id, text and item; empty tables give no
rows; further columns pass through ``drop_leaks`` untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from ebbflow.llm.arrow_text import mix64, sliced, text_array, words
from ebbflow.llm.store import write_once

WINDOW = 8
#: A few edits leave no window of 8 words of a short item, so those have smaller ones.
SHORT_WINDOW, LONG_ITEM = 5, 40
SHORTEST = 4
#: Plain words that a window must hold (in a shorter item: half of its words).
MIN_WORDS = 4
COVERAGE = 0.6
#: Diagonals at most so many words apart belong to one copy.
GAP = 5
#: So many consecutive words of an item are a leak, whatever their share of it.
RUN = 16
#: The bitmap over window hashes has 2**BITMAP_BITS bits.
BITMAP_BITS = 24

NUMBER = re.compile(r"[+\-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?|\d*\.\d+")
QUANTITY = re.compile(r"([+\-]?\d[\d.,]*)([a-zµ°]{1,3})")
# Spellings that count as units after a number.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams
kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne tonnes ml l liter liters litre litres
gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year
years percent degree degrees dollar dollars euro euros cent cents meter meters metre metres kilometer
kilometers kilometre kilometres""".split())
OUTER = ".,;:!?\"'()[]{}<>«»“”‘’…"
STOPS = ".!?:\""

WORD, NUM, UNIT, NAME = 0, 1, 2, 3
PLACEHOLDERS = {NUM: "<number>", UNIT: "<unit>", NAME: "<name>"}
WINDOW_SCHEMA = "pos int, hash long, kinds string, slots array<string>"


def classify(word: str) -> tuple[str, int, bool, bool, bool, bool, bool]:
    """(bare lower-case word, NUM or WORD, may be a name, may be a unit, ends a sentence, has
    punctuation before it, after it)."""
    bare = word.strip(OUTER)
    low = bare.lower()
    number = bool(NUMBER.fullmatch(low) or (q := QUANTITY.fullmatch(low)) and q[2] in UNITS)
    return (low, NUM if number else WORD, bare[:1].isupper(), low in UNITS, word.rstrip(")]}»”’'")[-1:] in tuple(STOPS),
            word[:1] in OUTER, word[-1:] in OUTER)


@dataclass
class Parsed:
    """Bare words of some texts: kind without names, hash of the plain word, whether it is
    capitalised, stands at the start of a sentence, continues a run of capitalised words; and
    the offsets of the texts."""

    low: np.ndarray
    kind: np.ndarray
    plain: np.ndarray
    capital: np.ndarray
    starts: np.ndarray
    joined: np.ndarray
    at: np.ndarray


MARKS = np.array([0, *(xxh64_intdigest(PLACEHOLDERS[k].encode()) for k in (NUM, UNIT, NAME))], np.uint64)


def parse(texts: pa.Array) -> Parsed:
    flat, at = words(texts)
    coded = flat.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    looked = [classify(w) for w in coded.dictionary.to_pylist()]
    low = np.array([x[0] for x in looked], object)
    number, capital, unit, stop, before, after = (
        np.array([x[k] for x in looked], bool)[which] if looked else np.zeros(0, bool) for k in range(1, 7))
    begins = np.zeros(len(which), bool)
    begins[at[:-1][np.diff(at) > 0]] = True
    starts = np.concatenate([[True], stop[:-1]])[: len(which)] | begins
    after_number = np.concatenate([[False], number[:-1]])[: len(which)] & ~begins
    kind = np.where(number, NUM, np.where(unit & after_number, UNIT, WORD))
    capital &= kind == WORD
    joined = np.concatenate([[False], capital[:-1] & ~after[:-1]])[: len(which)] & capital & ~before & ~begins
    plain = np.array([xxh64_intdigest(w.encode()) for w in low], np.uint64)
    keep = ~np.array([not w for w in low], bool)[which] if len(low) else np.zeros(0, bool)  # not punctuation alone
    total = np.concatenate([[0], np.cumsum(keep)])
    return Parsed(low[which][keep], kind[keep], plain[which][keep] if len(plain) else np.zeros(0, np.uint64),
                  capital[keep], starts[keep], joined[keep], total[at])


def readings(p: Parsed):
    """Template words of the texts, read three ways: first word of each and the next one's, kind,
    hash, offsets of the texts."""
    for name in (np.zeros(len(p.low), bool), p.capital, p.capital & ~p.starts):
        kind = np.where(name, NAME, p.kind)
        follows = p.joined & name & np.concatenate([[False], name[:-1]])[: len(name)]
        first = np.flatnonzero(~follows)
        kind = kind[first]
        yield (first, np.append(first[1:], len(name)), kind, np.where(kind == WORD, p.plain[first], MARKS[kind]),
               np.searchsorted(first, p.at))


def window_hashes(hashes: np.ndarray, kind: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` words, and whether it holds ``least`` plain words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    spread = mix64(hashes)
    key = np.full(n, size, np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + spread[k:n + k]
    total = np.concatenate([[0], np.cumsum(kind == WORD)])
    return mix64(key), total[size:] - total[:-size] >= least


def least_words(size: int) -> int:
    return MIN_WORDS if size >= WINDOW else (size + 1) // 2


def windows_of(texts: pa.Array, sizes: list[int], bitmap: np.ndarray):
    """(text, position, hash, kinds, slots) of the valid windows that ``bitmap`` lets through;
    a window that several readings have in common is given once."""
    p = parse(texts)
    found = {}
    for first, after, kind, hashes, at in readings(p):
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for size in sizes:
            key, valid = window_hashes(hashes, kind, size, least_words(size))
            valid &= owner[: len(key)] == owner[size - 1:]
            place = key >> np.uint64(64 - BITMAP_BITS)
            valid &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            for i in np.flatnonzero(valid).tolist():
                same = int(first[i]), int(key[i])
                if same not in found:
                    found[same] = (owner[i], first[i] - p.at[owner[i]], key[i],
                                   *slots_of(p.low, [(first[k], after[k], kind[k]) for k in range(i, i + size)]))
    return list(zip(*found.values())) or [()] * 5


def slots_of(low, tokens) -> tuple[str, list[str]]:
    return "".join(str(k) for _, _, k in tokens), [" ".join(low[a:b]) for a, b, k in tokens if k != WORD]


def item_windows(p: Parsed):
    """Every valid window of one item, as its template words (first word, next one's, kind):
    each capitalised word is read as a plain word, and with the rest of its run as a name."""
    n = len(p.low)
    window = WINDOW if n >= LONG_ITEM else SHORT_WINDOW
    run_end = np.arange(1, n + 1)
    for i in range(n - 2, -1, -1):
        if p.joined[i + 1]:
            run_end[i] = run_end[i + 1]
    for start in range(n):
        open_ = [(start, ())]
        while open_:
            at, tokens = open_.pop()
            if len(tokens) == window or at == n:
                size, least = len(tokens), least_words(len(tokens))
                whole = size == window or start == 0 and size >= SHORTEST
                if whole and sum(k == WORD for _, _, k in tokens) >= least:
                    yield tokens
                continue
            if sum(k != WORD for _, _, k in tokens) > window - least_words(window):
                continue
            open_.append((at + 1, (*tokens, (at, at + 1, int(p.kind[at])))))
            if p.capital[at]:
                open_.append((int(run_end[at]), (*tokens, (at, int(run_end[at]), NAME))))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, n_windows and n_words (of the item; words in no valid window are not counted), size,
    pos, end, hash, kinds, slots of every valid window."""
    def run(batches):
        for part in sliced(batches):
            for row in range(part.num_rows):
                one = part.slice(row, 1)
                p = parse(text_array(one.column("text")))
                found = sorted(item_windows(p), key=len)
                if not found:
                    continue
                key = np.concatenate([
                    window_hashes(np.array([p.plain[a] if k == WORD else MARKS[k] for a, _, k in w], np.uint64),
                                  np.array([k for _, _, k in w]), len(w), 0)[0] for w in found])
                kinds, slots = zip(*(slots_of(p.low, w) for w in found))
                pos, end = [w[0][0] for w in found], [w[-1][1] for w in found]
                n_words = covered([{"item_pos": a, "item_end": b} for a, b in zip(pos, end)])[0]
                n = len(found)
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.concat_arrays([one.column("item_id")] * n),
                    "n_windows": pa.array([len(set(pos))] * n, pa.int32()), "n_words": pa.array([n_words] * n, pa.int32()),
                    "size": pa.array(map(len, found), pa.int32()), "end": pa.array(end, pa.int32()),
                    "pos": pa.array(pos, pa.int32()), "hash": pa.array(key.view(np.int64)),
                    "kinds": pa.array(kinds, pa.string()), "slots": pa.array(slots, pa.list_(pa.string()))})

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, n_windows int, n_words int, size int, end int, {WINDOW_SCHEMA}")


def bitmap_of(windows: DataFrame) -> np.ndarray:
    """Bitmap over the first ``BITMAP_BITS`` bits of the hashes; at most 2**BITMAP_BITS / 32
    rows reach the driver, whatever the benchmark's size."""
    word = F.shiftrightunsigned("hash", 64 - BITMAP_BITS + 5)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 31 as int))")
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in windows.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toLocalIterator():
        out[r["w"]] = r["b"]
    return out.view(np.uint8)


def document_windows(docs: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    def run(batches):
        for part in sliced(batches):
            row, pos, key, kinds, slots = windows_of(text_array(part.column("text")), sizes, bitmap)
            if not row:
                continue
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").take(row), "text_hash": part.column("text_hash").take(row),
                "n_bytes": part.column("n_bytes").take(row),
                "pos": pa.array(pos, pa.int32()), "hash": pa.array(np.array(key, np.uint64).view(np.int64)),
                "kinds": pa.array(kinds, pa.string()), "slots": pa.array(slots, pa.list_(pa.string()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_bytes int, {WINDOW_SCHEMA}")


class Slots:
    """Slot values of an item and what they stand for in a document, one to one."""

    def __init__(self):
        self.there, self.back = {}, {}

    def add(self, found: list[dict]) -> bool:
        """Take in the slots of these matches; nothing is taken if they contradict."""
        there, back = {}, {}
        for m in found:
            for a, b in m["fixed"]:
                if self.there.get(a, there.setdefault(a, b)) != b or self.back.get(b, back.setdefault(b, a)) != a:
                    return False
                if there[a] != b or back[b] != a:
                    return False
        self.there |= there
        self.back |= back
        return True


def covered(found: list[dict]) -> tuple[int, int]:
    """Item words that the matches cover, and the most of them in a row."""
    total = longest = run = 0
    end = -1
    for a, b in sorted({(m["item_pos"], m["item_end"]) for m in found}):
        run = run if a <= end else 0
        new = max(0, b - max(a, end))
        total, run, end = total + new, run + new, max(end, b)
        longest = max(longest, run)
    return total, longest


def compare(m: dict) -> None:
    """Add to a match: ``fixed`` (slot pairs to map one to one), ``same`` (all slots equal)
    and ``same_names``. A name at an edge of the window may run on in the document."""
    edges = [(r"(?s).*(?<!\w)%s", 0)] * (m["kinds"][0] == str(NAME)) + [(r"(?s)%s(?!\w).*", -1)] * (m["kinds"][-1] == str(NAME))
    mine, theirs = list(m["item_slots"]), list(m["slots"])
    soft = set()
    for pattern, k in edges:
        soft.add(k % len(mine))
        if re.fullmatch(pattern.replace("%s", re.escape(mine[k])), theirs[k]):
            theirs[k] = mine[k]
    names = [x == str(NAME) for x in m["kinds"] if x != str(WORD)]
    m["same"] = mine == theirs
    m["same_names"] = all(a == b for a, b, name in zip(mine, theirs, names) if name)
    m["fixed"] = [x for k, x in enumerate(zip(mine, theirs)) if k not in soft]


def without_contradiction(found: list[dict], slots: Slots) -> list[dict]:
    """The matches, those with the item's names, or none: the first that fit ``slots``."""
    for some in (found, [m for m in found if m["same_names"]]):
        if slots.add(some):
            return some
    return []


def best_copy(found: list[dict], n_words: int, coverage: float) -> tuple[int, bool] | None:
    """(item windows matched, verbatim) of the matches between one document and one item, or
    None if no copy among them counts."""
    diagonals: dict[int, list[dict]] = {}
    for m in found:
        compare(m)
        diagonals.setdefault(m["pos"] - m["item_pos"], []).append(m)
    at = sorted(diagonals)
    cuts = [0, *(k for k in range(1, len(at)) if at[k] - at[k - 1] > GAP), len(at)]
    best = []

    def judge(copy: list[dict], share: float) -> None:
        total, run = covered(copy)
        if copy and (total >= share * n_words or run >= RUN):
            best.append((len({m["item_pos"] for m in copy}), all(m["same"] for m in copy)))

    for a, b in zip(cuts[:-1], cuts[1:]):
        copy, slots, total = [], Slots(), 0
        for d in sorted(at[a:b], key=lambda d: (-len(diagonals[d]), d)):
            alone = diagonals[d]
            if copy and (total == n_words or covered(copy + alone)[0] == total):
                if not all(m["same"] for m in copy):  # perhaps a verbatim copy beside another
                    judge(without_contradiction(alone, Slots()), coverage)
                continue
            fit = without_contradiction(alone, slots)
            if fit:
                copy += fit
                total = covered(copy)[0]
            if len(fit) < len(alone):
                judge([m for m in alone if m["same"]], float("inf"))
                judge(without_contradiction(alone, Slots()), coverage)
        judge(copy, coverage)
    return (max(n for n, _ in best), any(same for _, same in best)) if best else None


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document text and benchmark item found in it: doc_id, item_id, n_matched,
    n_windows, kind ("verbatim" or "reparameterised"), text_hash and n_bytes."""
    bench = write_once(benchmark_windows(items), "benchmark-windows")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most WINDOW values
    if not sizes:
        sizes = [WINDOW]
    found = write_once(document_windows(docs, sizes, bitmap_of(bench)).distinct(), "document-windows")
    pairs = found.join(bench.select("item_id", "n_windows", "n_words", "hash", "kinds", F.col("pos").alias("item_pos"),
                                    F.col("end").alias("item_end"), F.col("slots").alias("item_slots")), ["hash", "kinds"])
    pairs = pairs.groupBy("doc_id", "text_hash", "n_bytes", "item_id", "n_windows", "n_words").agg(
        F.collect_list(F.struct("pos", "item_pos", "item_end", "kinds", "item_slots", "slots")).alias("found"))

    def run(batches):
        for batch in batches:
            n_words, matches = batch.column("n_words").to_pylist(), batch.column("found")
            copies = [best_copy(matches[k].as_py(), n, coverage) for k, n in enumerate(n_words)]
            keep = pa.array([k for k, c in enumerate(copies) if c], pa.int64())
            copies = [c for c in copies if c]
            columns = {c: batch.column(c).take(keep) for c in ("doc_id", "item_id", "n_windows", "text_hash", "n_bytes")}
            columns["n_matched"] = pa.array([n for n, _ in copies], pa.int64())
            columns["kind"] = pa.array(["verbatim" if same else "reparameterised" for _, same in copies], pa.string())
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in names})

    names = ["doc_id", "item_id", "n_matched", "n_windows", "kind", "text_hash", "n_bytes"]
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema.fields} | {"n_matched": "long", "kind": "string"}
    return pairs.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))


def drop_leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    key = "k" * (1 + max(map(len, docs.columns)))  # no column of docs has this name
    bad = leaks(docs, items, coverage).select(F.col("text_hash").alias(key + "t"), F.col("n_bytes").alias(key + "n")).distinct()
    return docs.join(bad, (F.xxhash64("text") == F.col(key + "t")) & (F.octet_length("text") == F.col(key + "n")), "left_anti")
