"""Token files and packing: round trips against the tokenizer on whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import nnls_packing as NP, pfor_tokens as PF, tokens as TK

KINDS = [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")]


@pytest.mark.parametrize("kind,name", KINDS)
def test_pieces_give_the_ids_of_whole_texts(kind, name, corpus):
    rnd = random.Random(1)
    signs = list("ab Zé'sßñ\n\n  \t.,!1290\r xyz") + ["'re", "　", "漢", "́", "<|endoftext|>", "İ", "Σ", "µ", "'S", "​", "  ", "\n\n"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += [r.text for r in corpus.select("text").limit(60).collect()]
    e = TK.PieceEncoder(TK.tokenizer_path(name), kind)
    ids, at = e.encode(pa.array(texts, pa.large_string()))
    for k, want in enumerate(e.full(texts)):
        assert ids[at[k]:at[k + 1]].tolist() == want, texts[k]


def test_blocks_round_trip():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 3000):
        for top in (1, 2, 1000, 49408, 2**32 - 1):
            ids = rnd.integers(0, top, n)
            ids[rnd.random(n) < 0.05] = 2**31
            lengths = [n // 3, n - n // 3, 0]
            seg = PF.Segment(PF.encode_segment([5, None, -1], lengths, ids))
            assert seg.ids().tolist() == ids.tolist() and seg.doc_ids == [5, None, -1] and seg.lengths.tolist() == lengths
            a, b = sorted(rnd.integers(0, n + 1, 2))
            assert seg.ids(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        PF.Segment(b"????" + bytes(20))


def test_outliers_become_exceptions():
    ids = np.r_[np.arange(250), 60000, 61000, 62000]
    image = PF.encode_segment([1], [len(ids)], ids)
    assert PF.Segment(image).ids().tolist() == ids.tolist()
    assert len(image) < 4 * len(ids) / 2


def whole(docs, kind, name, end):
    e = TK.PieceEncoder(TK.tokenizer_path(name), kind)
    got = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    return [(d, t, ids + [end]) for (d, t), ids in zip(got, e.full([t or "" for _, t in got]))]


@pytest.mark.parametrize("which", ["corpus", "edge_docs"])
def test_files_hold_every_document_in_order(spark, request, which):
    docs = request.getfixturevalue(which)
    want = sorted(whole(docs, *KINDS[0], 1), key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1]))
    got = sorted(PF.read(spark, PF.write(docs)).collect(), key=lambda r: r.start)
    at = 0
    assert len(got) == len(want)
    for r, (d, _, ids) in zip(got, want):
        assert (r.doc_id, r.start, r.n_tokens) == (d, at, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    assert PF.read(spark, PF.write(docs.limit(0))).count() == 0


@pytest.mark.parametrize("which", ["corpus", "edge_docs"])
def test_packing_holds_each_id_once(request, which):
    docs = request.getfixturevalue(which)
    got = NP.pack(docs).collect()
    sequences, texts = {}, {}
    for r in got:
        assert 0 < r.length <= 1024 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert sum(e for e in (max(o + n for o, n in p) for p in sequences.values())) > 1024 * (len(sequences) - 1)
    want = {}
    for d, _, ids in whole(docs, *KINDS[1], 0):
        want.setdefault((d, len(ids)), []).append(ids)
    assert set(want) == set(texts)
    for key, docs_of in want.items():
        assert sorted(i for x in docs_of for i in x) == sorted(i for _, x in texts[key] for i in x)
        if len(docs_of) == 1:
            assert [i for _, x in sorted(texts[key]) for i in x] == docs_of[0]
    assert NP.pack(docs.limit(0)).count() == 0


def test_plan_uses_patterns_and_places_every_rest_once():
    rnd = np.random.default_rng(4)
    for histogram in (rnd.integers(0, 400, 1024), np.bincount([600] * 5000, minlength=1024), np.zeros(1024, np.int64)):
        histogram[0] = 0
        plan = NP.make_plan(histogram, 1024)
        used = np.zeros((plan.n_pattern + plan.n_left, 1024), np.int8)
        for length in np.flatnonzero(histogram):
            for rank in range(histogram[length]):
                for _, n, sequence, offset in plan.place(int(length), rank):
                    used[sequence, offset:offset + n] += 1
        assert used.max(initial=0) <= 1 and used[:-1].all()
    plan = NP.make_plan(rnd.integers(300, 400, 1024) * (np.arange(1024) > 0), 1024)
    assert plan.planned.sum() > 0.8 * 300 * 1023  # nearly all by patterns


def test_nnls_reaches_the_optimum():
    rows = np.array([[0, 1, 3], [0, 2, 2], [1, 1, 2]])
    target = np.array([0, 5.0, 4.0, 3.0])
    x = NP.nnls(rows, target)
    a = np.zeros((4, 3))
    for c, row in enumerate(rows):
        for v in row:
            a[v, c] += v > 0
    gradient = a.T @ (a @ x - target)
    assert (x >= 0).all() and (gradient > -1e-6).all() and abs(gradient @ x) < 1e-5


@pytest.mark.parametrize("kind,name", KINDS)
def test_added_tokens_as_the_library_reads_them(kind, name):
    from tokenizers import Tokenizer
    texts = ["hello <|endoftext|> x", "a<|startoftext|>b", "<|endoftext|>", "plain text\nof two lines", "x <|ENDOFTEXT|> y",
             "<|endoftext|><|startoftext|> It's  two\n\n<|endoftext", "", "hello <|endoftext|> x"]
    ids, at = TK.PieceEncoder(TK.tokenizer_path(name), kind).encode(pa.array(texts, pa.large_string()))
    library = Tokenizer.from_file(TK.tokenizer_path(name))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_counts_meet_the_optimality_conditions():
    """Of all two- and three-part fills: no gradient is positive, and that of a counted fill is zero."""
    rnd = np.random.default_rng(4)
    for window, n in ((12, 40), (40, 300), (64, 50), (200, 3000)):
        histogram = np.bincount(rnd.integers(1, window, n), minlength=window)
        histogram[rnd.integers(1, window)] += n  # one length holds half of all rests
        rows = NP.combinations_filling(window, histogram > 0)
        every = [(a, b, window - a - b) for a in range(window) for b in range(a, window) if b and b <= window - a - b]
        assert sorted(map(tuple, rows)) == sorted(t for t in every if all(v == 0 or histogram[v] for v in t))
        x = NP.nnls(rows, histogram.astype(float))
        rest = histogram - np.array([sum(x[c] * (rows[c] == v).sum() for c in range(len(rows)) if v in rows[c]) if v else 0 for v in range(window)])
        gradient = np.array([sum(rest[v] for v in r if v) for r in rows])
        assert (x >= 0).all() and gradient.max(initial=-1) < 1e-6 * histogram.max() and np.abs(gradient[x > 0]).max(initial=0) < 1e-5
        assert (x > 0).sum() < window
    assert NP.nnls(NP.combinations_filling(8, np.zeros(8, bool)), np.zeros(8)).tolist() == []


def test_most_rests_are_planned():
    histogram = np.bincount(np.random.default_rng(5).integers(1, 1024, 10_000), minlength=1024)
    plan = NP.make_plan(histogram, 1024)
    assert plan.planned.sum() > 0.9 * histogram.sum()
