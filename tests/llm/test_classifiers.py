"""The line model and the byte network: exact against brute force, and held-out accuracy."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from ebbflow.llm import byte_gru as BG, line_crf as LC

MID = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(1)
    steps = rnd.normal(size=(2, 2))
    lengths = [5, 1, 3, 1]
    at = np.concatenate([[0], np.cumsum(lengths)])
    e = rnd.normal(size=at[-1])
    table, order, n = LC.padded(e, at)
    ahead, back = LC.forward_backward(table, n, steps)
    for column, doc in enumerate(order):
        x = e[at[doc]:at[doc + 1]]
        total, good = 0.0, np.zeros(len(x))
        for y in itertools.product([0, 1], repeat=len(x)):
            w = np.exp(sum(x[t] * y[t] for t in range(len(x))) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
        got = LC.sigmoid(ahead + back)[: len(x), column]
        assert np.allclose(got, good / total)


def test_line_features_of_plain_cases():
    texts = pa.array(["AB cd!\n\n  \nx x x", "", "  "], pa.large_string())
    x, length, at = LC.line_features(texts)
    assert at.tolist() == [0, 2, 3, 4] and length.tolist() == [6, 5, 1, 1]
    assert x[0][1] == pytest.approx(2 / 6) and x[0][12] == 1 and x[1][9] == pytest.approx(2 / 3)
    assert not x[2:].any()


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    model = LC.fit(docs, labels)
    rows = LC.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == labels.count() and 0.1 < len(held) / len(rows) < 0.3
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    kept = LC.keep_good(docs, model)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in LC.score(docs, model).collect() if r.predicted}


def test_scores_do_not_depend_on_the_batch():
    rnd = np.random.default_rng(3)
    texts = ["\n".join("Ab cd 12!" if rnd.random() < 0.5 else "x x | x" for _ in range(n)) for n in (1, 40, 2, 3, 0, 200, 1, 7)]
    model = LC.Model(np.zeros(LC.N_FEATURES), np.ones(LC.N_FEATURES),
                     rnd.normal(size=3 * LC.N_FEATURES + 3), rnd.normal(size=(2, 2)))
    together = LC.document_scores(pa.array(texts), model)
    assert np.allclose(together, [LC.document_scores(pa.array([t]), model)[0] for t in texts])


def test_one_text_of_many_lines_is_not_padded_with_the_rest():
    import tracemalloc

    model = LC.Model(np.zeros(LC.N_FEATURES), np.ones(LC.N_FEATURES), np.ones(3 * LC.N_FEATURES + 3), np.ones((2, 2)))
    texts = pa.array(["a\n" * 50_000] + ["a line of words"] * 5_000)
    tracemalloc.start()
    scores = LC.document_scores(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Padded together these texts would take 50,000 x 5,001 doubles, 2 GB.
    assert len(scores) == 5_001 and peak < 200 << 20


def test_quality_edges(spark, edge_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (6, 1), (None, 0), (8, None)], "doc_id long, quality int")
    for model in (LC.fit(edge_docs, labels), LC.fit(edge_docs, labels.limit(0))):
        rows = LC.score(edge_docs, model).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert LC.score(edge_docs.limit(0), model).count() == 0
        assert LC.keep_good(edge_docs, model).columns == edge_docs.columns


def test_gradients_equal_differences():
    rnd = np.random.default_rng(2)
    net = BG.new_network(["a", "b", "c"], 3, 5)
    for k, group in enumerate((net.tables, net.recurrent)):
        group[:] = [p.astype(np.float64) for p in group]
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x = rnd.integers(97, 103, (7, 4)).astype(np.int16)
    x[5:, 1] = BG.PAD
    y = np.array([0, 1, 2, 1])
    _, grads = BG.gradients(net, x, y)
    for p, g in zip(net.parameters(), grads):
        where = np.argsort(-np.abs(g).ravel())[:4]
        for i in where:
            old = p.flat[i]
            p.flat[i] = old + 1e-2
            up = BG.gradients(net, x, y)[0]
            p.flat[i] = old - 1e-2
            down = BG.gradients(net, x, y)[0]
            p.flat[i] = old
            assert g.flat[i] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4)


def test_segments_cover_every_byte():
    data = np.arange(200, dtype=np.uint8)
    rows, owner = BG.cut_segments(data, np.array([0, 0, 70, 200]), 64)
    assert [int((rows[owner == k] != BG.PAD).sum()) for k in range(3)] == [0, 70, 130]
    assert rows[rows != BG.PAD].tolist() == data.tolist()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    rows = BG.predict(docs, BG.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert 0.25 < len(held) / len(rows) < 0.42
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, edge_docs):
    for net in (BG.fit(edge_docs), BG.fit(edge_docs.limit(0))):
        rows = BG.predict(edge_docs, net).collect()
        assert len(rows) == edge_docs.count()
        und = {r.doc_id for r in rows if r.lang_pred == "und"}
        assert {2, 3, 4, 10, None} <= und
        assert BG.predict(edge_docs.limit(0), net).count() == 0
    assert BG.fit(edge_docs.limit(0)) is None
