"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from ebbflow.llm.licences import ASIDE, COPYRIGHT_LINE, KNOWN, MARKERS, NOT_STATED, SPELLINGS
from ebbflow.llm.revisits import MERGED


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_licence(text: str) -> str:
    t = f"regexp_replace(replace(lower({text}), chr(13), ''), {quoted(NOT_STATED)}, {quoted(ASIDE + chr(92) + '1')}, 'g')"
    t = f"replace(regexp_replace({t}, {quoted(COPYRIGHT_LINE)}, ' ', 'g'), {quoted(ASIDE)}, 'copyright')"
    t = f"trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for was, now in SPELLINGS:
        plain = now.replace("/", " ")
        if plain != was:
            t = f"regexp_replace({t}, {quoted(rf'\b{was}\b')}, {quoted(plain)}, 'g')"
    return t


def licences() -> str:
    marker = f"regexp_matches(lower({{}}), {quoted('|'.join(MARKERS))})"
    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN)
    return f"""
WITH known AS (SELECT {canonical_licence('text')} AS c, min(licence) AS licence
               FROM (VALUES {known}) AS v(licence, text) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
whole AS (SELECT r, licence FROM docs JOIN known ON {canonical_licence('docs.text')} = known.c
          WHERE {marker.format('docs.text')}),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs WHERE {marker.format('text')}),
hits AS (SELECT DISTINCT r, licence FROM lines JOIN known ON {canonical_licence('lines.line')} = known.c
         WHERE {marker.format('lines.line')}),
notices AS (SELECT r, string_agg(licence, ',' ORDER BY licence) AS notices FROM hits GROUP BY r)
SELECT doc_id, whole.licence AS whole_licence, notices FROM docs LEFT JOIN whole USING (r) LEFT JOIN notices USING (r)"""


CRC_TABLE = """(SELECT list(c ORDER BY i) FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))"""


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``text``, by table ``t.crc`` of 256 numbers."""
    hexed = f"hex(encode({text}))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))), "
            f"lambda k: ('0x' || substr({hexed}, 2 * k + 1, 2))::BIGINT)), "
            "lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])))")


def shards(n: int = 40, seed: int = 42) -> str:
    return f"""
WITH t AS (SELECT {CRC_TABLE} AS crc),
texts AS (SELECT DISTINCT coalesce(text, '') AS x FROM documents),
sums AS (SELECT x, {crc32('x')} AS crc FROM texts, t),
docs AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS stratum,
                octet_length(encode(x)) + 16 AS size, crc AS text_crc32
         FROM documents JOIN sums ON coalesce(text, '') = x),
hashed AS (SELECT *, md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32) AS h FROM docs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS r,
                  count(*) OVER (PARTITION BY stratum) AS total FROM hashed),
placed AS (SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * total), stratum, r) - 1 AS p, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (p * {n} // n)::INTEGER AS shard,
       (p - ((p * {n} // n) * n + {n - 1}) // {n})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed"""


def canonical_url(url: str) -> str:
    u = f"regexp_replace(lower(trim({url})), '#.*$', '', 'g')"
    for pattern, new in ((r"^https?://(www[0-9]*\.)?", ""), (r"^([^/:]+):(80|443)(/|$)", r"\1\3"),
                         (r"([?&])(utm_[a-z]+|ref|sessionid)=[^&]*", r"\1"), (r"&&+", "&"), (r"\?&+", "?"), (r"[?&/]+$", "")):
        u = f"regexp_replace({u}, {quoted(pattern)}, {quoted(new)}, 'g')"
    return u


def revisits() -> str:
    names = ("cache-control", "content-length", "content-type", "date", "etag", "last-modified", "vary")
    value = {n: f'"{n}"' for n in names}
    merged = []
    for n in names:
        new, old = f"v.{value[n]}", f"f.{value[n]}"
        after = f"coalesce({new}, {old})" if n in MERGED else old
        merged.append(f"'{n}: ' || CASE WHEN outcome IN ('resolved', 'unchecked') THEN {after} ELSE {new} END")
    return f"""
WITH pages2 AS (SELECT *, ('0x' || substr(md5(coalesce(url, '')), 1, 6))::BIGINT AS c,
                       '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag FROM pages),
f AS (SELECT page_id * 2 AS record_id, {canonical_url('url')} AS curl, page_id * 1000 AS "at", tag AS etag, 'day ' || c % 28 AS "last-modified",
             'text/html' AS "content-type", octet_length(encode(coalesce(html, '')))::VARCHAR AS "content-length", 'max-age=60' AS "cache-control",
             (page_id * 1000)::VARCHAR AS date, NULL::VARCHAR AS vary FROM pages2),
v AS (SELECT page_id * 2 + 1 AS record_id, {canonical_url("url || '#again'")} AS curl,
             CASE WHEN c % 11 = 0 THEN page_id * 1000 - 500 ELSE page_id * 1000 + 500 + (c % 200) * 1000 END AS "at",
             CASE WHEN c % 7 = 0 THEN NULL WHEN c % 5 = 0 THEN '"changed"' ELSE 'W/' || tag END AS etag, 'day ' || c % 28 AS "last-modified",
             NULL::VARCHAR AS "content-type", '0' AS "content-length", 'max-age=90' AS "cache-control", "at"::VARCHAR AS date, 'accept' AS vary FROM pages2),
j AS (SELECT v.record_id AS id, f.record_id AS response_id FROM v ASOF LEFT JOIN f ON v.curl = f.curl AND v."at" >= f."at"),
k AS (SELECT j.response_id, v.record_id,
             CASE WHEN j.response_id IS NULL THEN 'unresolved'
                  WHEN v.etag IS NOT NULL THEN CASE WHEN replace(v.etag, 'W/', '') = f.etag THEN 'resolved' ELSE 'mismatch' END
                  ELSE CASE WHEN v."last-modified" = f."last-modified" THEN 'resolved' ELSE 'mismatch' END END AS outcome
      FROM v JOIN j ON j.id = v.record_id LEFT JOIN f ON f.record_id = j.response_id)
SELECT v.record_id, v.curl, v."at", k.response_id, k.outcome,
       array_to_string(list_filter([{', '.join(merged)}], lambda x: x IS NOT NULL), chr(10)) AS headers
FROM k JOIN v USING (record_id) LEFT JOIN f ON f.record_id = k.response_id"""


def slot_negatives() -> str:
    return """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             (row_number() OVER (PARTITION BY p.a, p.vec_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
      FROM p JOIN s USING (a) WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def ranked_terms() -> str:
    terms = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents WHERE text IS NOT NULL),
docs AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*) AS nd, sum(n) AS nt FROM docs),
q AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT q.item_id, p.r, sum(q.k * floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT
                                 * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt)))) AS score
      FROM q JOIN p USING (term) JOIN f USING (term) JOIN docs USING (r), g GROUP BY ALL),
k AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score::BIGINT AS score
      FROM s JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


ORACLE = {"op6_revisits": revisits(), "op7_licence_digests": licences(), "op9_interleaved_shards": shards(),
          "op11_slot_negatives": slot_negatives(), "op13_term_pipeline": ranked_terms()}
