"""Registered queries of the operators, and their DuckDB SQL where SQL can say it.

A query applies one operator to its whole table and derives the digest columns
of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import bpe, decontaminate, hard_negatives, imatch, langid, line_dedup, sharding, simhash, suffix_dedup, toxicity, url_rules, vector_codes, warc
from .common import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register("op1_bpe_roundtrip")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; sizes and digests of both results."""
    ids = bpe.bpe_encode(_read(spark, sf_dir, "documents"), TOKENIZER)
    both = bpe.bpe_decode(ids, TOKENIZER)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d
"""


@register("op2_warc_normalise", _WARC_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as monolithic gzip WARC files, normalised, and read back."""
    raw, out = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    warc.write_monolithic(warc.page_records(_read(spark, sf_dir, "pages")), raw)
    warc.normalise(spark, raw, out)
    return warc.read_archives(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def in_fold() -> F.Column:
    """Documents that are held out from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def language_sample(docs: DataFrame) -> dict[str, list[str]]:
    return langid.labelled_sample(docs.where(~in_fold()))


@register("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    docs = _read(spark, sf_dir, "documents")
    return langid.predict_language(docs.select("doc_id", "text"), language_sample(docs)).select("doc_id", in_fold().alias("held_out"), "lang_pred", "score")


_SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
g AS (SELECT doc_id, n, c, substr(h, 1024 * c + 1, 1222) AS part FROM (SELECT doc_id, n, h, unnest(range(0, (n + 412) // 512)) AS c FROM d)),
w AS (SELECT doc_id, 512 * c + j AS i, md5_number(substr(part, 2 * j + 1, 200)) AS bytes
      FROM (SELECT doc_id, c, part, unnest(range(0, least(512, n - 99 - 512 * c))) AS j FROM g)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, i) AS k FROM w),
c AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS new FROM f WHERE k > 1),
r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c),
s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM r GROUP BY doc_id, run),
t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM s),
k AS (SELECT t.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
             string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept, max(b) AS last
      FROM t JOIN d ON t.doc_id = d.doc_id GROUP BY t.doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


@register("op4_suffix_dedup", _SUFFIX_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of 100-byte strings that start earlier."""
    done = suffix_dedup.dedup_substrings(_read(spark, sf_dir, "documents"), 100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _sharding_sql(shards: int = 16) -> str:
    """The smallest capacity by a table over (shards so far, groups so far), then greedy cuts;
    CRC-32 bit by bit, as a fold over each byte and seven zeros."""
    steps = [f"c1 AS (SELECT i, total AS most FROM g)"] + [
        f"c{k} AS (SELECT g.i, min(greatest(p.most, g.total - b.total)) AS most FROM g JOIN c{k - 1} p ON p.i <= g.i JOIN b ON b.i = p.i GROUP BY g.i)" for k in range(2, shards + 1)
    ]
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, substr(sha256(coalesce(text, '')), 1, 32) AS grp,
         regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents),
h AS (SELECT doc_id, size, grp, xor(4294967295, list_reduce(
         list_prepend(4294967295::BIGINT, flatten(list_transform(bytes, lambda x: [CAST('0x' || x AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
         lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))) AS text_crc32 FROM d),
s AS (SELECT grp, sum(size) AS bytes FROM h GROUP BY grp),
g AS (SELECT row_number() OVER (ORDER BY grp) AS i, grp, CAST(sum(bytes) OVER (ORDER BY grp) AS BIGINT) AS total FROM s),
b AS (SELECT i, total FROM g),
{", ".join(steps)},
cap AS (SELECT most FROM c{shards} ORDER BY i DESC LIMIT 1),
cuts(shard, start, stop) AS (
  SELECT 0, CAST(0 AS BIGINT), (SELECT max(total) FROM g, cap WHERE total <= most)
  UNION ALL
  SELECT shard + 1, stop, (SELECT max(total) FROM g, cap WHERE total <= stop + most) FROM cuts WHERE stop < (SELECT max(total) FROM g))
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h.grp, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM h JOIN g ON h.grp = g.grp JOIN cuts ON g.total > cuts.start AND g.total <= cuts.stop
"""


@register("op5_sharding", _sharding_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    done = sharding.shard_by_bytes(_read(spark, sf_dir, "documents"), 16)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)
), frequent AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.key = f.key GROUP BY doc_id
"""


@register("op6_line_dedup", _LINES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents have are dropped everywhere."""
    done = line_dedup.drop_frequent_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op7_imatch")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every text and of its edited text, and their likeness."""
    return imatch.edit_resilience(_read(spark, sf_dir, "documents"))


@register("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row for each document and item."""
    return decontaminate.benchmark_matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


#: Host, path and verdict of the explicit rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


_URL_SQL = f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
u AS (SELECT host, path, count(*) AS n, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels FROM p GROUP BY host, path),
rules(rule_host, rule_path, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
e AS (
  SELECT host, path, rule_host || rule_path AS rule, v FROM u JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) = 1),
t AS (
  SELECT u.host, u.path, n, rule, v, list_sort(list_distinct(
    list_transform(labels, lambda x: 'h:' || x)
    || CASE WHEN len(labels) > 1 THEN ['s:' || array_to_string(labels[-2:], '.')] ELSE [] END
    || list_transform(list_filter(string_split(u.path, '/'), lambda x: x <> ''), lambda x: 'p:' || x))) AS tokens
  FROM u LEFT JOIN e ON u.host = e.host AND u.path = e.path),
total AS (SELECT sum(n) AS n FROM t WHERE v IS NOT NULL AND len(tokens) > 0),
part AS (SELECT v, n, tokens, unnest(range(1, 1 << len(tokens))) AS mask FROM t WHERE v IS NOT NULL AND len(tokens) > 0),
item AS (SELECT v, n, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS tokens FROM part),
counted AS (SELECT tokens, v, sum(n) AS n_both, sum(sum(n)) OVER (PARTITION BY tokens) AS n_alone FROM item GROUP BY tokens, v),
mined AS (
  SELECT tokens, v, CAST(n_both AS DOUBLE) / CAST(n_alone AS DOUBLE) AS confidence, CAST(n_both AS DOUBLE) / CAST(total.n AS DOUBLE) AS support
  FROM counted, total WHERE n_both >= ceil({url_rules.MIN_SUPPORT} * total.n) AND CAST(n_both AS DOUBLE) / CAST(n_alone AS DOUBLE) >= {url_rules.MIN_CONFIDENCE}),
kept AS (
  SELECT * FROM mined m WHERE NOT EXISTS (
    SELECT 1 FROM mined o WHERE o.v = m.v AND len(o.tokens) < len(m.tokens) AND o.confidence >= m.confidence AND list_has_all(m.tokens, o.tokens))),
fired AS (
  SELECT host, path, k.v FROM t JOIN kept k ON list_has_all(t.tokens, k.tokens) WHERE t.v IS NULL
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY confidence DESC, support DESC, len(k.tokens) DESC, array_to_string(k.tokens, ' ') DESC, k.v DESC) = 1)
SELECT page_id, p.host, p.path, rule, coalesce(t.v, fired.v, 'allow') AS verdict
FROM p JOIN t ON p.host = t.host AND p.path = t.path LEFT JOIN fired ON p.host = fired.host AND p.path = fired.path
"""


@register("op9_url_rules", _URL_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every url: the explicit rule's, else that of the mined rules."""
    return url_rules.judge_urls(_read(spark, sf_dir, "pages"), URL_RULES)


@register("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    groups = simhash.simhash_groups(_read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def _codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Rounds of assignment and means as a chain of tables; sums of whole numbers are exact in doubles."""
    ctes = [
        f"""k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS (SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v FROM k, range({parts}) AS r(p))",
        f"b0 AS (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM p) WHERE e < {entries})",
    ]
    for i in range(rounds + 1):
        ctes.append(
            f"""a{i} AS (SELECT vec_id, label, p, v, min({{'d': d, 'e': e}}) AS s FROM (
  SELECT p.vec_id, p.label, p.p, p.v, e, list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v) AS d
  FROM p JOIN b{i} b ON p.p = b.p) GROUP BY vec_id, label, p, v)"""
        )
        if i < rounds:
            ctes.append(
                f"""b{i + 1} AS (SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN (
  SELECT p, e, list(m ORDER BY j) AS v FROM (
    SELECT p, s.e AS e, j, CAST(floor(sum(v[j]) / count(*)) AS DOUBLE) AS m FROM a{i}, range(1, (SELECT max(len(v)) FROM p) + 1) AS r(j) GROUP BY p, s.e, j) GROUP BY p, e) n
  ON b.p = n.p AND b.e = n.e)"""
            )
    return f"""
WITH {", ".join(ctes)},
f AS (SELECT vec_id, label, string_agg(printf('%02x', s.e), '' ORDER BY p) AS code, CAST(sum(s.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label),
g AS (SELECT string_agg(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e) AS t FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha256(t) AS codebooks_sha256 FROM f, g
"""


@register("op11_vector_codes", _codes_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors in four codebooks of 256 entries, with their errors."""
    codes, books = vector_codes.compress_vectors(_read(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    digest = F.lit(books.digest() if books else None).cast("string")
    return vector_codes.with_label_error(codes).select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


@register("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labelled documents that are not held out."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(toxicity.labelled_texts(docs.where(~in_fold()), labels.where(~in_fold())))
    return toxicity.score_toxicity(docs, model).select("doc_id", in_fold().alias("held_out"), "score", "predicted")


_NEGATIVES_SQL = f"""
WITH k AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({hard_negatives.SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id AS id, r.label, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM k a JOIN k r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.own AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


@register("op13_hard_negatives", _NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
