"""Licence lookup on variants of known texts."""

import re

import pytest
from pyspark.sql import functions as F

from ebbflow.llm import licences as LI

MIT = next(t for n, t in LI.KNOWN if n == "MIT" and "hereby" in t)
ZLIB = next(t for n, t in LI.KNOWN if n == "Zlib")


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.whole_licence, r.notices) for r in LI.scan(df).collect()}


def test_variants_of_whole_texts(spark):
    texts = [MIT, "Copyright (c) 2001 Someone\n" + MIT.upper(), MIT.replace("\n", " ").replace(",", ""),
             "(C) 1999, 2000 X\nAll rights reserved.\n\n" + ZLIB.replace("acknowledgment", "acknowledgement"),
             MIT + " more", MIT.replace("free of charge", "for a fee")]
    assert scan(spark, texts) == {0: ("MIT", None), 1: ("MIT", None), 2: ("MIT", "MIT"), 3: ("Zlib", None), 4: (None, None), 5: (None, None)}


def test_notice_lines(spark):
    texts = ["Released under the MIT License.\nsome text\n  licensed UNDER cc by-nc 4.0",
             "We like the MIT License.", "This work is licenced under the GNU General Public Licence, version 3"]
    got = scan(spark, texts)
    assert got[0] == (None, "CC-BY-NC-4.0,MIT") and got[1] == (None, None) and got[2] == ("GPL-3.0-only", "GPL-3.0-only")


def test_edges(edge_docs, spark):
    got = LI.scan(edge_docs).collect()
    assert len(got) == edge_docs.count() and all(r.whole_licence is None and r.notices is None for r in got)
    assert LI.scan(edge_docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, MIT), (1, MIT), (None, MIT)], "doc_id long, text string")
    assert [r.whole_licence for r in LI.scan(twice).collect()] == ["MIT"] * 3
    long = "word " * 100_000 + "\nReleased under the MIT License."
    assert scan(spark, [long])[0] == (None, "MIT")


def test_markers_lose_nothing(corpus):
    """Reducing every line gives the same notices as reducing lines with a marker."""
    lines = corpus.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    hits = lines.withColumn("digest", F.sha2(LI.canonical(F.col("line")), 256)).join(LI.known_digests(corpus.sparkSession), "digest")
    want = {(r.doc_id, r.licence) for r in hits.collect()}
    got = {(r.doc_id, n) for r in LI.scan(corpus).collect() for n in (r.notices or "").split(",") if n}
    assert got == want and want


def test_known_texts_need_a_marker(spark):
    with pytest.raises(ValueError):
        LI.known_digests(spark, [("X", "do as you like")])


def test_no_python_in_the_plan(corpus, capsys):
    LI.scan(corpus).explain()
    assert "Python" not in (out := capsys.readouterr().out) and "Arrow" not in out


def test_full_texts_with_and_without_title(spark):
    full = dict(LI.FULL)
    c = "Copyright (c) 2019 Some One\n\n"
    apache, bsd = full["Apache-2.0"], full["BSD-2-Clause"]
    isc = next(t for n, t in LI.SHORT if n == "ISC" and "hereby" in t)
    texts = ["MIT License\n\n" + c + MIT, "The MIT License (MIT)\n" + c + MIT, "ISC License\n\n" + c + isc, "zlib License\n\n" + c + ZLIB,
             apache, apache[apache.index("TERMS AND CONDITIONS"):apache.index("END OF TERMS")],
             apache.replace("[yyyy] [name of copyright owner]", "2020 X Inc."), "BSD 2-Clause License\n\n" + c + bsd, c + full["BSD-3-Clause"],
             full["GPL-3.0-only"], full["GPL-2.0-only"], full["LGPL-3.0-only"], full["MPL-2.0"].split("\n", 2)[2], full["CC-BY-SA-4.0"]]
    want = ["MIT", "MIT", "ISC", "Zlib", "Apache-2.0", "Apache-2.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-only",
            "GPL-2.0-only", "LGPL-3.0-only", "MPL-2.0", "CC-BY-SA-4.0"]
    assert [x[0] for _, x in sorted(scan(spark, texts).items())] == want


def test_only_stated_copyrights_are_dropped(spark):
    wrapped = " ".join(MIT.split()).replace(" COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace(" copyright notice", "\ncopyright notice")
    bsd = " ".join(dict(LI.FULL)["BSD-2-Clause"].split()).replace(" COPYRIGHT HOLDERS AND CONTRIBUTORS ", "\nCOPYRIGHT HOLDERS AND CONTRIBUTORS\n")
    texts = [wrapped, bsd, "Copyright The X Authors\n" + wrapped, "Copyright Example Inc.\n© X\n" + bsd, "copyright 2001-2004 by X\n" + bsd]
    got = scan(spark, texts)
    assert [got[k][0] for k in range(5)] == ["MIT", "BSD-2-Clause", "MIT", "BSD-2-Clause", "BSD-2-Clause"]


def test_markers_come_from_the_table():
    assert all(any(m in t.lower() for m in LI.MARKERS) for _, t in LI.KNOWN)
    assert LI.markers_of([("X", "do as you like")])[-1] in "do as you like"


def test_holders_without_a_year(spark):
    texts = ["Copyright Jane Doe <j@x.org>\n\n" + MIT, "MIT License\n\nCopyright (c) Jane Doe\n\n" + MIT, "copyright by Jane\n" + MIT, "Copyright law is hard.\n" + MIT]
    assert [scan(spark, texts)[k][0] for k in range(4)] == ["MIT", "MIT", "MIT", None]


def test_sql_and_operator_agree_on_full_texts(spark):
    """Every known text, plain, re-wrapped, with CRLF, commented, and under a copyright line."""
    import textwrap

    import duckdb
    from ebbflow.llm.oracle_sql import licences
    rows = []
    own = re.compile(LI.COPYRIGHT_LINE)
    for n, t in LI.KNOWN:
        wrapped = ["\n".join(textwrap.wrap(t, width)) for width in (57, 72)]
        # no line of its own that reads like a copyright line, wherever lines end
        wrapped = [t if any(own.search(re.sub(LI.NOT_STATED, LI.ASIDE, x.lower())) for x in (t, w)) else w for w in wrapped]
        rows += [t, wrapped[0], t.replace("\n", "\r\n"), "\n".join("# " + line for line in t.splitlines()),
                 "Copyright (c) 2020-2021 A. Holder\nAll rights reserved.\n\n" + t, "Copyright The X Authors\n" + wrapped[1], t + " also"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = sorted(map(tuple, LI.scan(df).collect()))
    c = duckdb.connect()
    documents = df.toPandas()  # noqa: F841 - read by the SQL
    assert sorted(c.execute(licences()).fetchall()) == got
    whole = [w for _, w, _ in got]
    assert all(w for k, w in enumerate(whole) if k % 7 != 6) and not any(w for k, w in enumerate(whole) if k % 7 == 6)
