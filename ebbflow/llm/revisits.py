"""WARC: resolution of not-modified revisits.

A revisit record (status 304) carries no body. It is resolved to the latest earlier full
response (status 200) of the same canonical URL: an as-of join. The validators are then
checked (equal ETag under weak comparison; where the revisit has none, equal Last-Modified),
and the headers that a 304 may update replace those of the stored response.

The as-of join is a running maximum over time. A URL with a third of all records must not
meet in one task, so time is cut into ``TIME_BUCKETS`` equal ranges: inside a range a window
finds the latest response, and where there is none the last response of the earlier ranges
of that URL (one row per URL and range) is taken. Only keys and headers move; bodies stay in
the table and are fetched by ``response_id``.

Defined results: a null URL is a canonical URL of its own (null); a revisit without an
earlier response is "unresolved", one whose validators differ "mismatch", one without any
validator on either side "unchecked"; a response at the same time counts as earlier; among
equal times the larger record id is the latest; equal rows are separate records; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TIME_BUCKETS = 256
# Headers that a 304 response may update.
MERGED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Lower-case, without scheme, fragment, leading www, default port, tracking
    parameters and trailing signs."""
    u = F.regexp_replace(F.lower(F.trim(url)), r"#.*$", "")
    u = F.regexp_replace(u, r"^https?://(www[0-9]*\.)?", "")
    u = F.regexp_replace(u, r"^([^/:]+):(80|443)(/|$)", "$1$3")
    u = F.regexp_replace(u, r"([?&])(utm_[a-z]+|ref|sessionid)=[^&]*", "$1")
    u = F.regexp_replace(u, r"&&+", "&")
    u = F.regexp_replace(u, r"\?&+", "?")
    return F.regexp_replace(u, r"[?&/]+$", "")


def weak(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """``records``: record_id, url, at (long), status, headers (map). One row per 304 record:
    record_id, curl, at, response_id, outcome, headers (merged; its own if not resolved)."""
    rows = records.where("status in (200, 304)").select(
        "record_id", canonical_url(F.col("url")).alias("curl"), "at", "status", "headers")
    span = rows.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    first, width = span["a"] or 0, max(1, ((span["b"] or 0) - (span["a"] or 0)) // TIME_BUCKETS + 1)
    bucket = F.expr(f"(at - {first}L) div {width}L")
    # Maps have no order, so the running maximum is over times and ids; headers follow by id.
    seen = F.when(F.col("status") == 200, F.struct("at", "record_id"))
    rows = rows.withColumn("bucket", bucket).withColumn("seen", seen)
    order = Window.partitionBy("curl", "bucket").orderBy("at", "status", "record_id")
    inside = rows.withColumn("latest", F.max("seen").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    inside = inside.where("status = 304").drop("seen")
    ranges = rows.groupBy("curl", "bucket").agg(F.max("seen").alias("top"))
    before = Window.partitionBy("curl").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("carried", F.max("top").over(before)).select(
        F.col("curl").alias("r_curl"), F.col("bucket").alias("r_bucket"), "carried")
    found = inside.join(ranges, F.col("curl").eqNullSafe(F.col("r_curl")) & (F.col("bucket") == F.col("r_bucket")), "left")
    found = found.withColumn("response_id", F.coalesce("latest", "carried")["record_id"])
    stored = rows.where("status = 200").select(F.col("record_id").alias("s_id"), F.col("headers").alias("stored"))
    stored = stored.groupBy("s_id").agg(F.first("stored").alias("stored"))  # a record may be listed twice
    # Unresolved records have no key to join on; together they would meet in one task.
    lost = found.where("response_id is null").withColumn("stored", F.lit(None).cast("map<string,string>"))
    joined = found.join(stored, F.col("response_id") == F.col("s_id")).drop("s_id").unionByName(lost)
    new, old = F.col("headers"), F.col("stored")
    by_etag = weak(new["etag"]) == weak(old["etag"])
    by_date = new["last-modified"] == old["last-modified"]
    outcome = (F.when(F.col("response_id").isNull(), "unresolved")
               .when(new["etag"].isNotNull() & old["etag"].isNotNull(), F.when(by_etag, "resolved").otherwise("mismatch"))
               .when(new["last-modified"].isNotNull() & old["last-modified"].isNotNull(),
                     F.when(by_date, "resolved").otherwise("mismatch"))
               .otherwise("unchecked"))
    allowed = F.map_filter(new, lambda k, v: k.isin(*MERGED))
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(F.coalesce(F.map_keys(allowed), F.array().cast("array<string>")), k))
    merged = F.map_concat(kept, F.coalesce(allowed, F.create_map().cast("map<string,string>")))
    return joined.withColumn("outcome", outcome).select(
        "record_id", "curl", "at", "response_id", "outcome",
        F.when(F.col("outcome").isin("resolved", "unchecked"), F.coalesce(merged, new)).otherwise(new).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as sorted "name: value" lines."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return F.array_join(entries, "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log over ``pages``: each page was fetched in full (at 1000 x page_id) and asked
    for again later, under a variant of its URL. One in five answers carries another ETag, one
    in seven only a date, and one in eleven came before the first fetch of its page."""
    c = F.conv(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 6), 16, 10).cast("long")
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    day = F.concat(F.lit("day "), (c % 28).cast("string"))
    text = lambda col: col.cast("string")
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 1000).alias("at"), F.lit(200).alias("status"),
        F.create_map(F.lit("etag"), etag, F.lit("last-modified"), day, F.lit("content-type"), F.lit("text/html"),
                     F.lit("content-length"), text(F.octet_length(F.coalesce("html", F.lit("")))),
                     F.lit("cache-control"), F.lit("max-age=60"), F.lit("date"), text(F.col("page_id") * 1000)).alias("headers"))
    at = F.when(c % 11 == 0, F.col("page_id") * 1000 - 500).otherwise(F.col("page_id") * 1000 + 500 + (c % 200) * 1000)
    tag = F.when(c % 7 == 0, F.lit(None)).when(c % 5 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), etag))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), at.alias("at"),
        F.lit(304).alias("status"),
        F.map_filter(F.create_map(F.lit("etag"), tag, F.lit("last-modified"), day, F.lit("content-length"), F.lit("0"),
                                  F.lit("cache-control"), F.lit("max-age=90"), F.lit("date"), text(at),
                                  F.lit("vary"), F.lit("accept")), lambda k, v: v.isNotNull()).alias("headers"))
    return full.unionByName(again)
