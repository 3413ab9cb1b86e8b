"""Ids of whole texts with a public tokenizer, encoded by distinct pieces.

Calling the tokenizer on whole texts spends most of its time on words it has seen
before. Both tokenizers cut a text at white space before anything else, so the ids
of a text are the ids of its pieces in order. ``PieceEncoder`` cuts a batch into
pieces with Arrow, encodes each distinct piece once, and spreads the ids back.
Plain pieces (ASCII and Latin-1 letters, digits, ASCII signs) go to the
tokenizer's model directly; all others go through its full ``encode``. Texts whose
white space the cut doesn't cover (tabs, long runs, other Unicode spaces), and
texts that hold an added token (``<|endoftext|>``), are encoded whole. The tests hold
the result against ``encode`` of whole texts.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[ \n]?[{LETTER}0-9!-/:-@\[-`{{-~]*")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PARTS = re.compile(rf"{CONTRACTIONS}|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")
BYTE_PARTS = re.compile(rf"{CONTRACTIONS}| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s")

#: White space that the cut into pieces doesn't cover.
OTHER_SPACE = (r"[ \n]{3}|[ \n]{2}\z|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]")

#: Pieces (and parts of pieces) whose ids a generation of the cache holds; there are two.
GENERATION = 250_000

#: Text bytes cut and encoded at once.
SLICE_BYTES = 4 << 20


class Recent:
    """Ids (as bytes of int32) of recently seen strings: when the young generation is full
    it becomes the old one, and what is looked up again moves back."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def get(self, key: str) -> bytes:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = self.make(key)
            if len(self.young) >= GENERATION:
                self.old, self.young = self.young, {}
            self.young[key] = got
        return got


def shared_encoder(path: str, kind: str) -> "PieceEncoder":
    """The encoder of this Python worker, kept (with its cache) for the worker's later tasks."""
    kept = sys.modules.setdefault("ebbflow_worker_cache", ModuleType("ebbflow_worker_cache")).__dict__
    if (path, kind) not in kept:
        kept[path, kind] = PieceEncoder(path, kind)
    return kept[path, kind]


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file by its name; a path is returned as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others count up from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class PieceEncoder:
    """Encodes Arrow text columns; ``kind`` is "word" (lower-cased, white space
    dropped, word ends marked) or "byte" (byte-level, a space belongs to the next word)."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Added tokens stand in one piece of the raw text; one that is looked for after normalising,
        #: or that holds white space, may be in any.
        self.added = ["" if t.normalized or re.search(r"\s", t.content) else t.content for t in added]
        self.kind = kind
        self.alphabet = byte_alphabet()
        self.parts = Recent(self.encode_part)
        self.pieces = Recent(self.encode_piece)

    def full(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode_part(self, part: str) -> bytes:
        spelled = part if part.isascii() and part.isalpha() else part.encode().decode("latin-1").translate(self.alphabet)
        return array("i", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def encode_piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable() or PLAIN.fullmatch(piece)):
            return array("i", self.full([piece])[0]).tobytes()
        found = WORD_PARTS.findall(piece.lower()) if self.kind == "word" else BYTE_PARTS.findall(piece)
        if len(found) == 1:
            return self.parts.get(found[0])
        return b"".join(map(self.parts.get, found))

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Flat pieces of the texts, and the offsets of the texts in them."""
        if self.kind == "word":
            lists = pc.ascii_split_whitespace(texts)
            return lists.values, np.asarray(lists.offsets, np.int64)
        # A marker goes before each newline, then every gap is one space: a piece that
        # starts with a newline had none before it, any other but the first had one.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(lists.offsets, np.int64)
        first = np.zeros(len(lists.values), bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        bare = np.asarray(pc.starts_with(lists.values, "\n")) | first
        prefix = pa.array(np.where(bare, "", " ")).cast(pa.large_string())
        return pc.binary_join_element_wise(prefix, lists.values, pa.scalar("", pa.large_string())), offsets

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (int32, flat), and the offsets of the texts in them."""
        if self.kind == "word":
            whole = np.zeros(len(texts), bool)
        else:
            whole = np.asarray(pc.match_substring_regex(texts, OTHER_SPACE))
        pieces, piece_at = self.cut(texts)
        coded = pieces.dictionary_encode()
        ids = list(map(self.pieces.get, coded.dictionary.to_numpy(zero_copy_only=False)))
        lengths = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), np.int32)
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        which = coded.indices.to_numpy(zero_copy_only=False)
        holds = np.zeros(len(ids), bool)
        for token in self.added:
            holds |= np.asarray(pc.match_substring(coded.dictionary, token))
        if holds.any():
            before = np.concatenate([[0], np.cumsum(holds[which])])[piece_at]
            whole = whole | (before[1:] > before[:-1])
        long = lengths[which]
        ends = np.cumsum(long, dtype=np.int32)
        take = np.repeat(starts[which] - (ends - long), long)
        take += np.arange(len(take), dtype=np.int32)
        out = flat[take]
        at = np.concatenate([[0], ends]).astype(np.int64)[piece_at]
        if whole.any():
            rows = np.split(out, at[1:-1])
            for k, x in zip(np.flatnonzero(whole), self.full(texts.filter(pa.array(whole)).to_pylist())):
                rows[k] = np.array(x, np.int32)
            at = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
            out = np.concatenate(rows)
        return out, at
