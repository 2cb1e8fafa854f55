"""Registered queries of this subpackage: one per operator over its whole
table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (op1_sentencepiece, op2_sharding, op3_simhash, op4_toxicity, op5_html_extraction, op6_lm_scoring, op7_line_dedup,
               op8_token_counts, op9_minhash, op10_decontamination, op11_vector_codes, op12_jaccard_join, op13_divergence)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_ffbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, seeded by its id, and whether
    decoding gives its text back."""
    return op1_sentencepiece.encode(table(spark, sf_dir, "documents"))


def op2_sharding_kk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    return op2_sharding.shard(table(spark, sf_dir, "documents"))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return op3_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return op4_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return op5_html_extraction.extract(table(spark, sf_dir, "pages"))


def op6_lm_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document."""
    return op6_lm_scoring.scores(table(spark, sf_dir, "documents"))


def op7_line_dedup_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of the kept lines of every document."""
    return op7_line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def edits_of(docs: DataFrame) -> DataFrame:
    """Stand-in edits, three for every document: a passage of its own text
    pasted over 40 characters, its source inserted, 200 characters cut."""
    n = F.greatest(F.length("text"), F.lit(1))
    at = lambda k: F.pmod(F.xxhash64(F.lit(k), "doc_id"), n)
    edit = lambda k, length, text: F.struct(F.lit(k).alias("seq"), at(k).alias("start"), F.lit(length).alias("length"),
                                            text.alias("replacement"))
    paste = F.substring("text", F.pmod(F.xxhash64(F.lit(9), "doc_id"), n).cast("int") + 1, F.lit(60))
    return docs.select("doc_id", F.explode(F.array(
        edit(1, 40, paste), edit(2, 0, F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" "))),
        edit(3, 200, F.lit("")))).alias("e")).select("doc_id", "e.*")


def op8_token_counts_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits."""
    docs = table(spark, sf_dir, "documents")
    return op8_token_counts.count_with_edits(docs, edits_of(docs))


def op9_fingerprints_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return op9_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document by verified MinHash band joins."""
    return op9_minhash.similar(table(spark, sf_dir, "documents"))


def op10_decontamination_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    return op10_decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, by GNATs over the codebooks."""
    return op11_vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_jaccard_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shingle sets alike by 0.8 or more."""
    return op12_jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op13_divergence_quadtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its lang, and its own terms."""
    return op13_divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sentencepiece_ffbs, op2_sharding_kk, op3_simhash_golay, op4_toxicity_zstd, op5_html_suffix_array,
    op6_lm_deleted_interpolation, op7_line_dedup_bloom, op8_token_counts_edits, op9_fingerprints_minhash,
    op10_decontamination_wu_manber, op11_vector_codes_gnat, op12_jaccard_prefix_tree, op13_divergence_quadtree, minhash_classes,
    pipeline)}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "op7_line_dedup_bloom": rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_AZ}) AS k FROM lines),
firsts AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT keyed.*, coalesce(first_doc < doc_id, false) AS gone FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_decontamination_wu_manber": rf"""
WITH items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, {_AZ}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                              lambda w: w <> '') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS m,
         array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(ws) - least(10, len(ws)) + 2, 1))) AS r(i) WHERE len(ws) > 0),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                             lambda w: w <> '') AS ws FROM documents),
spots AS (
  SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT m FROM windows) AS lens, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS r(i)),
found AS (SELECT doc_id, i, spots.m, item_id FROM spots JOIN windows USING (m, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + m)) AS q(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_vector_codes_gnat": """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS q FROM kept, unnest(range(16)) AS r(p)),
book0 AS (
  SELECT p, e, q AS c FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
near0 AS (
  SELECT vec_id, p, any_value(q) AS q, min(list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) * 64 + e) % 64 AS e
  FROM parts JOIN book0 USING (p) GROUP BY vec_id, p),
mean0 AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT p, e, i, sum(q[i]) AS s, count(*) AS n FROM near0, unnest(range(1, len(q) + 1)) AS r(i) GROUP BY p, e, i) GROUP BY p, e),
book1 AS (SELECT p, e, CAST(coalesce(mean0.c, book0.c) AS BIGINT[]) AS c FROM book0 LEFT JOIN mean0 USING (p, e)),
near1 AS (
  SELECT vec_id, p, any_value(q) AS q, min(list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) * 64 + e) % 64 AS e
  FROM parts JOIN book1 USING (p) GROUP BY vec_id, p),
mean1 AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT p, e, i, sum(q[i]) AS s, count(*) AS n FROM near1, unnest(range(1, len(q) + 1)) AS r(i) GROUP BY p, e, i) GROUP BY p, e),
book2 AS (SELECT p, e, CAST(coalesce(mean1.c, book1.c) AS BIGINT[]) AS c FROM book1 LEFT JOIN mean1 USING (p, e)),
near2 AS (
  SELECT vec_id, p, min(list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) * 64 + e) AS d
  FROM parts JOIN book2 USING (p) GROUP BY vec_id, p),
coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(d % 64 AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d // 64) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id),
books AS (
  SELECT sha256(coalesce(string_agg(CAST(c[i] AS VARCHAR), ',' ORDER BY p, e, i), '')) AS codebooks_sha256
  FROM book2, unnest(range(1, len(c) + 1)) AS r(i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books""",
    "op12_jaccard_prefix_tree": rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(ws) - least(5, len(ws)) + 2, 1))) AS r(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh AS x JOIN sh AS y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes AS m ON m.doc_id = a JOIN sizes AS o ON o.doc_id = b WHERE 100 * c >= 80 * (m.n + o.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM docs UNION SELECT reach.doc_id, b FROM reach JOIN links ON r = a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op13_divergence_quadtree": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (total + 2 * v) AS BIGINT) AS p,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (lang_total + 2 * v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
