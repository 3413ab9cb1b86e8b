"""Revisit resolution against a plain loop over all records."""

import random
import re

from pyspark.sql import functions as F

from ebbflow.llm import revisits as RV

SCHEMA = "record_id long, url string, at long, status int, headers map<string,string>"


def canonical(url):
    if url is None:
        return None
    u = re.sub(r"#.*$", "", url.strip().lower())
    u = re.sub(r"^https?://(www[0-9]*\.)?", "", u)
    u = re.sub(r"^([^/:]+):(80|443)(/|$)", r"\1\3", u)
    u = re.sub(r"([?&])(utm_[a-z]+|ref|sessionid)=[^&]*", r"\1", u)
    return re.sub(r"[?&/]+$", "", re.sub(r"\?&+", "?", re.sub(r"&&+", "&", u)))


def plain(records):
    out = []
    for i, url, at, status, h in records:
        if status != 304:
            continue
        c = canonical(url)
        full = [r for r in records if r[3] == 200 and canonical(r[1]) == c and r[2] <= at]
        best = max(full, key=lambda r: (r[2], r[0]), default=None)
        h, old = h or {}, (best[4] if best else None) or {}
        strip = lambda e: re.sub("^W/", "", e)
        if best is None:
            outcome = "unresolved"
        elif "etag" in h and "etag" in old:
            outcome = "resolved" if strip(h["etag"]) == strip(old["etag"]) else "mismatch"
        elif "last-modified" in h and "last-modified" in old:
            outcome = "resolved" if h["last-modified"] == old["last-modified"] else "mismatch"
        else:
            outcome = "unchecked"
        merged = {**old, **{k: v for k, v in h.items() if k in RV.MERGED}} if outcome in ("resolved", "unchecked") else h
        out.append((i, c, at, best[0] if best else None, outcome, sorted(merged.items())))
    return sorted(out, key=repr)


def run(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    got = [(r.record_id, r.curl, r.at, r.response_id, r.outcome, sorted((r.headers or {}).items())) for r in RV.resolve(df).collect()]
    return sorted(got, key=repr)


def test_equals_plain_loop(spark):
    rnd = random.Random(11)
    urls = ["http://a.org/x", "https://www.a.org/x/", "HTTP://A.org:80/x#f", "http://a.org/x?utm_source=q", "http://b.org/y?p=1&ref=z", "http://b.org/y?p=1", None]
    records = []
    for i in range(400):
        h = {"etag": rnd.choice(['"1"', 'W/"1"', '"2"'])} if rnd.random() < 0.6 else {}
        if rnd.random() < 0.6:
            h["last-modified"] = rnd.choice(["d1", "d2"])
        h |= {"date": str(i), "content-length": "9"}
        records.append((i, rnd.choice(urls), rnd.randrange(-50, 900), rnd.choice([200, 304, 304, 404]), h))
    assert run(spark, records) == plain([(a, b, c, d, e) for a, b, c, d, e in records])


def test_edges(spark):
    records = [(1, "http://a.org", 5, 200, {"etag": '"1"'}), (2, "http://a.org/", 5, 304, {"etag": '"1"'}),
               (3, "http://a.org", 4, 304, None), (4, None, 9, 304, None), (5, "", 9, 304, {})]
    assert run(spark, records) == plain(records)
    assert RV.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
    again = spark.createDataFrame(records * 2, SCHEMA)
    assert RV.resolve(again).count() == 8


def test_canonical_urls(spark):
    for a, b in [("http://www.x.org:80/p/?utm_campaign=1#z", "x.org/p"), ("https://x.org/?a=1&ref=2&b=3", "x.org/?a=1&b=3"),
                 ("HTTPS://X.org/A", "x.org/a")]:
        got = spark.createDataFrame([(a,)], "u string").select(RV.canonical_url(F.col("u"))).first()[0]
        assert got == b == canonical(a)
