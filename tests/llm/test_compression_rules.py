"""Quality rules against a plain per-text version."""

import re

import zstandard

from ebbflow.llm import compression_rules as CR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, bands=CR.Bands()):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 3000 else None
    if inside is None:
        seen = {}
        for i, w in enumerate(windows):
            seen.setdefault(w, []).append(i)
        inside = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    raw = text.encode()
    z = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
    ratio = len(raw) / len(z.compress(raw)) if raw else 0.0
    parts = [raw[i:i + bands.chunk] for i in range(0, len(raw) - bands.chunk + 1, bands.chunk)]
    bad = sum(not bands.chunk_lo <= len(p) / len(z.compress(p)) <= bands.chunk_hi for p in parts)
    if 1024 <= len(raw) < bands.chunk:
        parts = [raw[i:i + 512] for i in range(0, len(raw) - 511, 512)] + [raw[-512:]] * (len(raw) % 512 > 0)
        bad = sum(not 1.25 <= 512 / len(z.compress(p)) <= 2.7 for p in parts)
    band = sum(len(raw) >= b for b in bands.upto)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    kept = not failed and bands.lo[band] <= ratio <= bands.hi[band] and bad <= bands.bad_chunk_share * len(parts)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(inside), failed, kept)


def check(docs):
    want = sorted(((r.doc_id, *plain(r.text)) for r in docs.collect()), key=repr)
    got = CR.score(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_equals_plain_version(corpus):
    check(corpus)


def test_edges(edge_docs, spark):
    check(edge_docs)
    empty = edge_docs.limit(0)
    assert CR.score(empty).count() == 0 and CR.keep_good(empty).columns == empty.columns


def test_keep_good_keeps_rows_whole(corpus, edge_docs):
    kept = CR.keep_good(edge_docs)
    assert kept.schema == edge_docs.schema
    want = {r.doc_id for r in CR.score(corpus).where("kept").collect()}
    assert {r.doc_id for r in CR.keep_good(corpus).collect()} == want and len(want) < corpus.count()


def test_bands_reject_repetition_and_noise(spark, corpus):
    import base64
    import random
    rnd = random.Random(5)
    noise = base64.b64encode(rnd.randbytes(6000)).decode()
    noise = " ".join(noise[i:i + 7] for i in range(0, len(noise), 7))
    prose = max((r.text for r in corpus.where("doc_id % 10 = 0").collect() if len(set(r.text.split())) > 300), key=len)
    df = spark.createDataFrame([(1, noise), (2, "ab " * 3000), (3, prose)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in CR.score(df).collect()}
    assert kept == {1: False, 2: False, 3: True}


def test_junk_counts_wherever_it_stands(spark, corpus):
    import base64
    import random
    noise = base64.b64encode(random.Random(5).randbytes(1425)).decode()
    noise = " ".join(noise[i:i + 7] for i in range(0, len(noise), 7))[:1900]
    prose = max((r.text for r in corpus.where("doc_id % 10 = 0").collect() if len(set(r.text.split())) > 300), key=len)
    prose = prose.encode()[:2100].decode(errors="ignore")
    df = spark.createDataFrame([(1, prose + " " + noise), (2, noise + " " + prose), (3, prose), (4, prose[:900])], "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.n_chunks, r.n_bad_chunks) for r in CR.score(df).collect()}
    assert got == {1: (False, 2, 1), 2: (False, 2, 1), 3: (True, 2, 0), 4: (True, 1, 0)}


def test_mixtures_in_short_texts(spark, corpus):
    import base64
    import random
    prose = max((r.text for r in corpus.where("doc_id % 10 = 0").collect() if len(set(r.text.split())) > 300), key=len)
    rows = []
    for k, (n, m) in enumerate([(700, 1200), (900, 900), (1000, 900), (1900, 0), (1100, 0)]):
        noise = base64.b64encode(random.Random(k).randbytes(m)).decode()
        noise = " ".join(noise[i:i + 7] for i in range(0, len(noise), 7))[:m]
        good = prose.encode()[:n].decode(errors="ignore")
        rows += [(2 * k, good + " " + noise), (2 * k + 1, noise + " " + good)]
    kept = {r.doc_id: r.kept for r in CR.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {k: k >= 6 for k in range(10)}
