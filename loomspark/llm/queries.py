"""The queries of this subpackage, each an operator over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ._shared import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .sentencepiece_bpe import encode_decode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True, keep_text=False)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=5, query_every=50)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=400, passage=51)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    return search(table(spark, sf_dir, "embeddings"), k=10, query_every=100)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_lines(docs, counts=True).selectExpr("doc_id", "cast(lines_total as long) lines_total", "cast(lines_dropped as long) lines_dropped", "sha2(text, 256) kept_sha256")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import Rule, filter_urls

    rules = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_sentencepiece, op3_mixing, op4_topk, op5_suffix_dedup, op6_ann, op7_line_dedup, op8_url_filter, op9_jaccard, op10_quality)}


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15) AS o
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, sum(n) OVER () AS total, coalesce(sum(2 * n) OVER (ORDER BY 2 * n * (10 // w), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
         sum(w) OVER (ORDER BY 2 * n * (10 // w), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s),
c AS (SELECT *, (3 * total - 2 * caps) * w >= 4 * n * ws AS capped FROM r),
l AS (SELECT arg_min(caps, 2 * n * (10 // w)) AS caps, arg_min(ws, 2 * n * (10 // w)) AS ws
      FROM (SELECT *, row_number() OVER (ORDER BY 2 * n * (10 // w), source NULLS LAST) AS k FROM c WHERE NOT capped) WHERE k = 1),
t AS (
  SELECT source, n::BIGINT AS source_size,
         CASE WHEN capped THEN (2 * n)::DOUBLE ELSE ((3 * total - 2 * l.caps) * w)::DOUBLE / (2 * l.ws)::DOUBLE END AS target
  FROM c LEFT JOIN l ON true),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, floor(target - whole * source_size)::BIGINT AS need FROM p),
m AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.o)::BIGINT AS tied
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN need <= 0 OR size = 0 OR upto - tied >= need THEN 0 WHEN upto <= need THEN size ELSE size * (need - upto + tied) // tied END)::BIGINT AS taken
FROM m
"""


OP1_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY coalesce(html, '')) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY coalesce(html, '')) THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS refers_to
FROM pages
"""


OP4_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP7_SQL = """
WITH l AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
t AS (SELECT source, count(*) AS total FROM l GROUP BY source),
c AS (SELECT source, line, count(*) AS n
      FROM (SELECT source, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM l)
      WHERE line <> '' GROUP BY source, line),
b AS (SELECT c.source, list(line) AS bad FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 5 AND n > total * 0.05 GROUP BY c.source),
k AS (SELECT l.*, list_filter(ls, lambda x: NOT list_contains(coalesce(bad, []), trim(x, ' ' || chr(9) || chr(13)))) AS kept
      FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS lines_total, coalesce(len(ls) - len(kept), 0)::BIGINT AS lines_dropped,
       CASE WHEN text IS NOT NULL THEN sha256(CASE WHEN len(ls) = len(kept) THEN text ELSE array_to_string(kept, chr(10)) END) END AS kept_sha256
FROM k
"""


def _op8_sql(depth: int = 8) -> str:
    """The levels of the tree up to a depth that no path of the test tables goes beyond."""
    level = """
n{d} AS (SELECT *, segs[{d}] AS s FROM l{p}),
c{d} AS (SELECT host, t, s, sum(n) AS n, sum(lab) AS lab, sum(blk) AS blk FROM n{d} WHERE s IS NOT NULL GROUP BY ALL),
k{d} AS (
  SELECT host, t, s FROM (SELECT *, count(*) OVER w AS fan, sum(n) OVER w AS an, (sum(lab) OVER w)::DOUBLE AS al, (sum(blk) OVER w)::DOUBLE AS ab FROM c{d} WINDOW w AS (PARTITION BY host, t))
  WHERE (fan = 1 OR (lab >= 5 AND al - lab >= 5 AND
        abs(blk / lab::DOUBLE - (ab - blk) / (al - lab)) > CASE WHEN fan > 20 AND n < 0.05::DOUBLE * an THEN 4.0::DOUBLE ELSE 1.96::DOUBLE END * sqrt(ab / al * (1 - ab / al) * (1 / lab::DOUBLE + 1 / (al - lab)))))),
l{d} AS (
  SELECT host, segs, n, lab, blk, t || CASE WHEN n{d}.s IS NULL THEN '' WHEN k{d}.s IS NOT NULL THEN '/' || n{d}.s ELSE '/*' END AS t
  FROM n{d} LEFT JOIN k{d} USING (host, t, s)),"""
    return r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
  SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM h),
g AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said,
    CASE WHEN path = '' THEN []::VARCHAR[] ELSE list_transform(string_split(substr(path, 2), '/'),
      lambda s: CASE WHEN regexp_matches(s, '^[0-9a-fA-F-]{16,}$') THEN '*' ELSE regexp_replace(s, '[0-9]+', '*', 'g') END) END AS segs
  FROM r),
l0 AS (SELECT host, segs, count(*) AS n, count(said) AS lab, count(*) FILTER (said = 'block') AS blk, '' AS t FROM g GROUP BY host, segs),""" + "".join(level.format(d=d, p=d - 1) for d in range(1, depth + 1)) + f"""
f AS (SELECT host, segs, lab, blk, t AS template FROM l{depth}),
m AS (SELECT host, template, sum(lab)::DOUBLE AS lab, sum(blk)::DOUBLE AS blk FROM f GROUP BY ALL),
p AS (SELECT (sum(blk) + 1) / (sum(lab) + 2) AS prior FROM m),
o AS (SELECT host, (sum(blk) + 4.0::DOUBLE * any_value(prior)) / (sum(lab) + 4.0::DOUBLE) AS ph FROM m, p GROUP BY host),
v AS (SELECT m.host, template, (blk + 4.0::DOUBLE * ph) / (lab + 4.0::DOUBLE) AS purity FROM m JOIN o USING (host))
SELECT page_id, g.host, path, rule, coalesce(said, CASE WHEN purity >= 0.7 THEN 'block' ELSE 'allow' END) AS verdict, f.template, purity
FROM g JOIN f ON g.host = f.host AND g.segs = f.segs JOIN v ON f.host = v.host AND f.template = v.template
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filter": _op8_sql(), "op7_line_dedup": OP7_SQL, "op4_topk": OP4_SQL, "op1_warc": OP1_SQL, "op3_mixing": OP3_SQL}
