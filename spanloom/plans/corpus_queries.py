"""Queries of the corpus-statistics workload."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus_stats as C
from . import fixtures as X


def _entities(spark, d):
    return C.entities_table(X.bigbio_rows(spark, d, passages=False))


def _flat(df):
    """Means rounded, so that both engines agree."""
    return df.withColumn("mean", F.round("mean", 6))


def a17_entities_table(spark, d):
    return _entities(spark, d).drop("normalized")


def a18_corpus_counts(spark, d):
    return C.corpus_counts(X.bigbio_rows(spark, d, passages=False))


def a18_mentions_by_type(spark, d):
    return C.mentions_by_type(_entities(spark, d))


def a19_entities_per_document(spark, d):
    return _flat(C.entities_per_document(X.bigbio_rows(spark, d, passages=False)))


def a20_span_length_stats(spark, d):
    return _flat(C.span_length_stats(_entities(spark, d)))


def a21_normalization_coverage(spark, d):
    return C.normalization_coverage(_entities(spark, d))


def a21_ids_per_database(spark, d):
    return C.ids_per_database(_entities(spark, d))


def j08_relations_with_entities(spark, d):
    return C.relations_table(X.bigbio_rows(spark, d, passages=False))


def a22_relation_stats(spark, d):
    return _flat(C.relation_stats(X.bigbio_rows(spark, d, passages=False)))


def a22_relations_by_type(spark, d):
    return C.relations_by_type(C.relations_table(X.bigbio_rows(spark, d, passages=False)))


def w03_top_mentions(spark, d):
    return C.top_mentions(_entities(spark, d))


def w04_top_relation_pairs(spark, d):
    return C.top_relation_pairs(C.relations_table(X.bigbio_rows(spark, d, passages=False)))


def w01_iob_mentions(spark, d):
    return C.iob_mentions(X.iob_rows(spark, d))


def w01_iob_token_mentions(spark, d):
    """The same mentions from one row per token."""
    tag = F.when(F.col("h") % 6 == 0, 1).when(F.col("h") % 6 == 1, 2).otherwise(0)
    tokens = X.spans(spark, d).select(F.col("document_id").alias("id"), F.col("pos").alias("position"), "token", tag.alias("ner_tag"))
    return C.iob_token_mentions(tokens)


def a23_tag_counts(spark, d):
    return C.tag_counts(X.iob_rows(spark, d))


def a24_mentions_per_sentence(spark, d):
    rows = X.iob_rows(spark, d)
    return _flat(C.mentions_per_sentence(rows, C.iob_mentions(rows)))


def a25_mention_token_length(spark, d):
    return _flat(C.mention_token_length(C.iob_mentions(X.iob_rows(spark, d))))


def w03_top_iob_mentions(spark, d):
    m = C.iob_mentions(X.iob_rows(spark, d)).select(F.lit("GENE").alias("type"), F.col("mention").alias("text"))
    return C.top_mentions(m, 10)


QUERIES = {f.__name__: f for f in (a17_entities_table, a18_corpus_counts, a18_mentions_by_type, a19_entities_per_document, a20_span_length_stats, a21_normalization_coverage, a21_ids_per_database, j08_relations_with_entities, a22_relation_stats, a22_relations_by_type, w03_top_mentions, w04_top_relation_pairs, w01_iob_mentions, w01_iob_token_mentions, a23_tag_counts, a24_mentions_per_sentence, a25_mention_token_length, w03_top_iob_mentions)}

_E = "WITH " + X.SQL_GOLD + """,
e AS (SELECT document_id, doc_id, ordinal, 'T' || ordinal AS id, CASE WHEN entity_type = 'gene' THEN 'Chemical' ELSE 'Disease' END AS type, span_text AS text, ids FROM goldt),
nx AS (SELECT *, lead(type) OVER w AS t2, lead(text) OVER w AS text2, lead(ids) OVER w AS ids2 FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY ordinal)),
rel AS (SELECT document_id, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) - 1 AS ordinal, 'CID' AS type,
  CASE WHEN type = 'Chemical' THEN text ELSE text2 END AS chemical, coalesce(CASE WHEN type = 'Chemical' THEN string_split(ids[1], ':')[2] ELSE string_split(ids2[1], ':')[2] END, '') AS chemical_id,
  CASE WHEN type = 'Disease' THEN text ELSE text2 END AS disease, coalesce(CASE WHEN type = 'Disease' THEN string_split(ids[1], ':')[2] ELSE string_split(ids2[1], ':')[2] END, '') AS disease_id FROM nx WHERE t2 <> type)"""
_I = "WITH " + X.SQL_SPANS + """,
tg AS (SELECT document_id AS id, token, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, CASE h % 6 WHEN 0 THEN 'B' WHEN 1 THEN 'I' ELSE 'O' END AS t FROM sp),
st AS (SELECT *, CASE WHEN t = 'B' OR (t = 'I' AND coalesce(lag(t) OVER (PARTITION BY id ORDER BY n), 'O') = 'O') THEN 1 ELSE 0 END AS s FROM tg),
gr AS (SELECT *, sum(s) OVER (PARTITION BY id ORDER BY n) AS k FROM st),
mention AS (SELECT id, CAST(k - 1 AS INTEGER) AS ordinal, string_agg(token, ' ' ORDER BY n) AS mention, CAST(count(*) AS INTEGER) AS n_tokens FROM gr WHERE t <> 'O' GROUP BY id, k)"""


def _describe(column: str, table: str) -> str:
    return f"SELECT count({column}) AS n, round(avg({column}), 6) AS mean, min({column}) AS min, CAST(quantile_cont({column}, 0.5) AS DOUBLE) AS median, max({column}) AS max FROM {table}"


ORACLE_SQL = {
    "a17_entities_table": _E + " SELECT document_id, CAST(ordinal - 1 AS INTEGER) AS ordinal, id, type, text, length(text) AS span_length, len(ids) AS norm_count FROM e",
    "a18_corpus_counts": _E + " SELECT (SELECT count(*) FROM docs) AS documents, count(*) AS mentions, count(DISTINCT document_id) AS documents_with_mentions FROM e",
    "a18_mentions_by_type": _E + " SELECT type, count(*) AS mentions FROM e GROUP BY ALL",
    "a19_entities_per_document": _E + ", c AS (SELECT count(*) AS x FROM e GROUP BY document_id) " + _describe("x", "c"),
    "a20_span_length_stats": _E + ", c AS (SELECT length(text) AS x FROM e) " + _describe("x", "c"),
    "a21_normalization_coverage": _E + " SELECT count(*) FILTER (WHERE len(ids) > 0) AS normalized, count(*) AS total, round_even(100.0 * count(*) FILTER (WHERE len(ids) > 0) / count(*), 1) AS pct FROM e",
    "a21_ids_per_database": _E + " SELECT string_split(x, ':')[1] AS db_name, count(*) AS ids FROM (SELECT unnest(ids) AS x FROM e) GROUP BY ALL",
    "j08_relations_with_entities": _E + " SELECT * REPLACE (CAST(ordinal AS INTEGER) AS ordinal) FROM rel",
    "a22_relation_stats": _E + ", c AS (SELECT count(*) AS x FROM rel GROUP BY document_id) " + _describe("x", "c"),
    "a22_relations_by_type": _E + " SELECT type, count(*) AS relations FROM rel GROUP BY ALL",
    "w03_top_mentions": _E + ", c AS (SELECT type, lower(text) AS text, count(*) AS mentions FROM e GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY mentions DESC, text) AS INTEGER) AS rank FROM c QUALIFY rank <= 5",
    "w04_top_relation_pairs": _E + " SELECT lower(chemical) || ' -> ' || lower(disease) AS pair, count(*) AS relations FROM rel GROUP BY ALL ORDER BY relations DESC, pair LIMIT 10",
    "w01_iob_mentions": _I + " SELECT * FROM mention",
    "w01_iob_token_mentions": _I + " SELECT * FROM mention",
    "a23_tag_counts": _I + " SELECT CASE t WHEN 'B' THEN 'B-GENE' WHEN 'I' THEN 'I-GENE' ELSE 'O' END AS tag, count(*) AS tokens FROM tg GROUP BY ALL",
    "a24_mentions_per_sentence": _I + ", c AS (SELECT id, count(mention.mention) AS x FROM (SELECT DISTINCT id FROM tg) LEFT JOIN mention USING (id) GROUP BY id) " + _describe("x", "c"),
    "a25_mention_token_length": _I + " " + _describe("n_tokens", "mention"),
    "w03_top_iob_mentions": _I + ", c AS (SELECT 'GENE' AS type, lower(mention) AS text, count(*) AS mentions FROM mention GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY mentions DESC, text) AS INTEGER) AS rank FROM c QUALIFY rank <= 10",
}
