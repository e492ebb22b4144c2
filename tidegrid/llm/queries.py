"""Named queries of this package over the driver's tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, decontaminate, language_id, line_dedup, piece_bpe, prefix_trie, simhash, toxicity, url_filter, warc, wavelet, weighted_sampling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}
# Rows with whole texts go to Python in batches of so many; the default of 10,000 could hold gigabytes.
BATCH_ROWS = 1_000


# Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            TWINS[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark))
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


@query(f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
rest AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
),
fits AS (
    SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) p
    JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path
""")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


@query(f"""
WITH rows AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
responses AS (
    SELECT payload_digest, max(page_id) AS response FROM rows WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < response THEN response END AS refers_to
FROM rows LEFT JOIN responses USING (payload_digest)
""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query(f"""
WITH lines AS (
    SELECT doc_id, source, pos, trim(line, ' ') AS k, line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
),
common AS (SELECT k, min(doc_id) AS first FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {line_dedup.SITES}),
marked AS (
    SELECT l.doc_id, pos, line,
           c.k IS NULL OR (c.first = l.doc_id AND row_number() OVER (PARTITION BY l.doc_id, l.k ORDER BY pos) = 1) AS stays
    FROM lines l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.strip(table(spark, sf_dir, "documents"), counts=True).select("doc_id", "text", "n_lines", "n_removed")


@query()
def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark, "word_bpe_49k.json")).decode()
    return wavelet.digests(spark, table(spark, sf_dir, "documents"), definition)


@query()
def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(table(spark, sf_dir, "documents"))


@query()
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark, "piece_bpe_32k.model"))
    return piece_bpe.digests(table(spark, sf_dir, "documents"), model)


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark, "byte_bpe_50k.json")).decode()
    model = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark, "piece_bpe_32k.model"))
    return alignment.digests(table(spark, sf_dir, "documents"), definition, model)


@query("""
WITH turns AS (
    SELECT conv_id AS c, role, text, sha256(octet_length(encode(role)) || ':' || role || text) AS name, turn
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
own AS MATERIALIZED (SELECT c, name, length(text) AS size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, name) AS p FROM turns),
-- CRC-32 of the decimal id, one bit at a time.
convs AS MATERIALIZED (
    SELECT c, c - c % 100 AS base,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
               lambda state, sign: list_reduce(list_prepend(xor(state, sign), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda s, zero: xor(s >> 1, 3988292384 * (s % 2)))
           )) % 6 AS h
    FROM (SELECT DISTINCT c FROM own)
),
rebuilt AS (
    SELECT v.c, o.p, o.name, o.size FROM convs v JOIN own o ON o.c = v.base AND o.p <= v.h
    UNION ALL SELECT v.c, 1000 + o.p, o.name, o.size FROM convs v JOIN own o ON o.c = v.c AND o.p > v.h
),
whole AS (
    SELECT v.c, coalesce(list(name ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS names, coalesce(list(size ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS sizes
    FROM convs v LEFT JOIN rebuilt r ON r.c = v.c GROUP BY v.c
),
prefixes AS (
    SELECT c, d, sha256(array_to_string(names[1:d], ',')) AS k, CASE WHEN d > 0 THEN sha256(array_to_string(names[1:d - 1], ',')) END AS up,
           len(names) = d AS ends, coalesce(sizes[d], 0) AS size
    FROM (SELECT *, unnest(range(len(names) + 1)) AS d FROM whole)
),
nodes AS MATERIALIZED (
    SELECT d, k, any_value(up) AS up, any_value(size) AS size, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY d, k
),
children AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY d, up),
-- Every node above a conversation's node, once per node and ancestor.
above AS (SELECT DISTINCT p.d, p.k, a.d AS a_d, a.k AS a_k FROM prefixes p JOIN prefixes a ON a.c = p.c AND a.d <= p.d),
sums AS (
    SELECT a_d AS d, a_k AS k, count(*) FILTER (WHERE ch.n IS NULL) AS leaves, sum((n.n_convs - 1) * n.size) AS saved
    FROM above JOIN nodes n USING (d, k) LEFT JOIN children ch USING (d, k) GROUP BY a_d, a_k
)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (d, k) LEFT JOIN children ch USING (d, k) LEFT JOIN nodes u ON u.d = n.d - 1 AND u.k = n.up
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.family_trie(table(spark, sf_dir, "conversations"))
