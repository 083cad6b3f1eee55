"""Queries of the annotation workload: harmonise, filter, group and write."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import harmonize as H
from ..operators import keywords as K
from . import fixtures as X

ROUND = 6


def _r(c: str, n: int = ROUND):
    return F.round(c, n).alias(c)


def p03_document_text(spark, d):
    return X.documents(spark, d).select("document_id", F.length("title").alias("title_chars"), F.length("text").alias("text_chars"), F.md5("text").alias("text_md5"))


def p07_make_annotation(spark, d):
    return X.annotations(spark, d).select("document_id", "annotation_id", "source", "ordinal", "start", "end", "entity_type", "canonical_id", _r("confidence"))


def p06_resolve_offsets(spark, d):
    docs = X.documents(spark, d)
    gold = X.gold_with_text(spark, d).select("doc_id", "document_id", "ordinal", "span_text").join(docs.select("doc_id", "text"), "doc_id")
    start, end = H.resolve_offsets(F.col("text"), F.col("span_text"), F.lit(None).cast("int"), F.lit(None).cast("int"))
    return gold.select("document_id", "ordinal", start.alias("found_start"), end.alias("found_end"))


def u01_flatten_annotations(spark, d):
    return X.annotations(spark, d).groupBy("source", "source_rank").agg(F.count("*").alias("n"), F.sum("ordinal").alias("ordinals"))


def p14_filter_by_type(spark, d):
    return H.filter_by_type(X.annotations(spark, d), ["Chemical"]).select("document_id", "annotation_id", "entity_type")


def p13_min_confidence(spark, d):
    return H.min_confidence(X.annotations(spark, d), 0.5).select("document_id", "annotation_id", _r("confidence"))


def p18_validate(spark, d):
    n = X.partitions(spark, d)
    docs = X.documents(spark, d).select("document_id", "text").repartition(n, "document_id")
    return H.validated(X.annotations(spark, d, dealt=n, columns=["document_id", "source", "span_text", "start", "end"]), docs).groupBy("source").agg(F.count_if("offsets_ok").alias("offsets_ok"), F.count_if("text_ok").alias("text_ok"), F.count("*").alias("n"))


def p19_split_regions(spark, d):
    return H.split_regions(X.annotations(spark, d), X.documents(spark, d)).groupBy("document_id", "region").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


def a02_keyword_groups(spark, d):
    g = K.keyword_groups(X.annotations(spark, d, dealt=X.partitions(spark, d)), dealt=True)
    return g.select("document_id", "keyword", "normalized_keyword", "mention_count", "annotation_count", "annotator_count", F.array_join("variants", "|").alias("variants"), F.array_join("labels", "|").alias("labels"), F.array_join("canonical_ids", "|").alias("canonical_ids"), F.array_join("annotation_ids", "|").alias("annotation_ids"))


def a03_keyword_mentions(spark, d):
    return K.keyword_mentions(X.annotations(spark, d, dealt=X.partitions(spark, d)), dealt=True).withColumn("annotation_ids", F.array_join("annotation_ids", "|"))


def k01_annotations_table(spark, d):
    return K.annotations_table(X.annotations(spark, d), X.documents(spark, d)).withColumn("confidence", F.round("confidence", ROUND))


def k02_keywords_table(spark, d):
    return K.keywords_table(K.keyword_summaries(X.annotations(spark, d, dealt=X.partitions(spark, d)), dealt=True), X.documents(spark, d))


def k03_keyword_evidence(spark, d):
    return K.keyword_evidence_table(X.annotations(spark, d, dealt=X.partitions(spark, d)), X.documents(spark, d), dealt=True).withColumn("confidence", F.round("confidence", ROUND))


def a04_annotator_summary(spark, d):
    return K.annotator_summary(_statuses(spark, d)).withColumnRenamed("name", "annotator")


def _statuses(spark, d):
    return K.annotator_statuses(X.annotations(spark, d, columns=["document_id", "source"]), X.documents(spark, d), [*X.ANNOTATORS, "a6"])


def a05_document_annotations(spark, d):
    a = X.annotations(spark, d, columns=["document_id", "annotation_id", "entity_type", "source_rank", "ordinal"])
    return K.document_annotation_summary(a, _statuses(spark, d), H.filter_by_type(a, ["disease"]))


def a06_ingestion_summary(spark, d):
    return K.ingestion_summary(X.documents(spark, d))


def j06_attach_document(spark, d):
    rows = X.annotations(spark, d, columns=["document_id", "annotation_id", "ordinal"])
    return K.attach_document(rows, X.documents(spark, d))


def j07_resolve_annotation_ids(spark, d):
    a = X.annotations(spark, d, dealt=X.partitions(spark, d))
    return K.resolve_annotation_ids(K.keyword_mentions(a, dealt=True), a, dealt=True).select("document_id", "normalized_keyword", "start", "end", "annotation_id", "annotation.source", "annotation.canonical_id")


QUERIES = {f.__name__: f for f in (p03_document_text, p06_resolve_offsets, p07_make_annotation, u01_flatten_annotations, p13_min_confidence, p14_filter_by_type, p18_validate, p19_split_regions, a02_keyword_groups, a03_keyword_mentions, a04_annotator_summary, a05_document_annotations, a06_ingestion_summary, j06_attach_document, j07_resolve_annotation_ids, k01_annotations_table, k02_keywords_table, k03_keyword_evidence)}

FOLD = "replace(replace(lower({0}), 'ß', 'ss'), 'ς', 'σ')"
_A = "WITH " + X.SQL_PREDICTIONS
_KEYS = f""",
ids AS (SELECT *, CASE WHEN canonical_id IS NULL THEN [] WHEN canonical_id LIKE '[%]' THEN list_transform(string_split(substr(canonical_id, 2, length(canonical_id) - 2), ','), lambda x: trim(x, ' '''))
  ELSE [canonical_id] END AS vals FROM ann),
k AS (SELECT *, span_text AS keyword, {FOLD.format("span_text")} AS nk, source_rank * 10000000 + ordinal AS o,
  list_transform(vals, lambda x: CASE WHEN lower(x) LIKE 'mesh:%' THEN 'MESH:' || substr(x, 6) ELSE x END) AS cids FROM ids WHERE span_text <> '')"""
_GROUPS = _KEYS + """,
lastid AS (SELECT document_id, nk, annotation_id, arg_max(cids, o) AS cids FROM k GROUP BY ALL),
cid AS (SELECT document_id, nk, string_agg(DISTINCT c, '|' ORDER BY c) AS canonical_ids FROM (SELECT document_id, nk, unnest(cids) AS c FROM lastid) GROUP BY ALL),
m AS (SELECT document_id, nk, start_, end_, arg_min(keyword, o) AS text, count(*) AS annotation_count, count(DISTINCT source) AS annotator_count, string_agg(annotation_id, '|' ORDER BY annotation_id) AS annotation_ids FROM k GROUP BY ALL),
g AS (SELECT document_id, nk, arg_min(keyword, o) AS keyword, string_agg(DISTINCT keyword, '|' ORDER BY keyword) AS variants, count(*) AS annotation_count, count(DISTINCT source) AS annotator_count,
  string_agg(DISTINCT entity_type, '|' ORDER BY entity_type) AS labels, string_agg(DISTINCT source, '|' ORDER BY source) AS sources, string_agg(annotation_id, '|' ORDER BY annotation_id) AS annotation_ids FROM k GROUP BY ALL),
groups AS (SELECT g.*, coalesce(cid.canonical_ids, '') AS canonical_ids, (SELECT count(*) FROM m WHERE m.document_id = g.document_id AND m.nk = g.nk) AS mention_count FROM g LEFT JOIN cid USING (document_id, nk)),
lasta AS (SELECT document_id, annotation_id, arg_max(source, o) AS source, arg_max(entity_type, o) AS entity_type, arg_max(array_to_string(cids, '|'), o) AS cid, max(struct_pack(o := o, c := confidence)).c AS confidence, max(struct_pack(o := o, c := canonical_id)).c AS canonical_id FROM k GROUP BY ALL)"""

ORACLE_SQL = {
    "p03_document_text": f"WITH {X.SQL_DOCUMENTS} SELECT document_id, length(title) AS title_chars, length(text) AS text_chars, md5(text) AS text_md5 FROM docs",
    "p06_resolve_offsets": f"WITH {X.SQL_GOLD} SELECT document_id, ordinal, CAST(strpos(text, span_text) - 1 AS INTEGER) AS found_start, CAST(strpos(text, span_text) - 1 + length(span_text) AS INTEGER) AS found_end FROM goldt JOIN docs USING (doc_id, document_id)",
    "p07_make_annotation": _A + ' SELECT document_id, annotation_id, source, ordinal, start_ AS start, end_ AS "end", entity_type, canonical_id, round(confidence, 6) AS confidence FROM ann',
    "u01_flatten_annotations": _A + " SELECT source, source_rank, count(*) AS n, CAST(sum(ordinal) AS BIGINT) AS ordinals FROM ann GROUP BY ALL",
    "p13_min_confidence": _A + " SELECT document_id, annotation_id, round(confidence, 6) AS confidence FROM ann WHERE confidence >= 0.5",
    "p14_filter_by_type": _A + " SELECT document_id, annotation_id, entity_type FROM ann WHERE entity_type = 'drug'",
    "p18_validate": _A + " SELECT source, count(*) FILTER (WHERE start_ >= 0 AND start_ < end_ AND end_ <= length(text)) AS offsets_ok, count(*) FILTER (WHERE start_ < end_ AND end_ <= length(text) AND substr(text, start_ + 1, end_ - start_) = span_text) AS text_ok, count(*) AS n FROM ann JOIN docs USING (doc_id) GROUP BY ann.source".replace("SELECT source,", "SELECT ann.source,"),
    "p19_split_regions": _A + """, r AS (SELECT ann.document_id, CASE WHEN length(title) > 0 AND end_ <= length(title) THEN 'title' WHEN start_ >= b THEN 'abstract' END AS region, start_, end_, b
  FROM ann JOIN (SELECT *, CASE WHEN length(title) > 0 THEN length(title) + 2 ELSE 0 END AS b FROM docs) x USING (doc_id))
SELECT document_id, region, count(*) AS n, CAST(sum(start_ - CASE WHEN region = 'abstract' THEN b ELSE 0 END) AS BIGINT) AS starts, CAST(sum(end_ - CASE WHEN region = 'abstract' THEN b ELSE 0 END) AS BIGINT) AS ends FROM r WHERE region IS NOT NULL GROUP BY ALL""",
    "a02_keyword_groups": _A + _GROUPS + " SELECT document_id, keyword, nk AS normalized_keyword, mention_count, annotation_count, annotator_count, variants, labels, canonical_ids, annotation_ids FROM groups",
    "a03_keyword_mentions": _A + _GROUPS + ' SELECT document_id, nk AS normalized_keyword, start_ AS start, end_ AS "end", text, annotation_count, annotator_count, annotation_ids FROM m',
    "a04_annotator_summary": _A + ", s AS (SELECT unnest(['a1', 'a2', 'a3', 'a4', 'a5', 'a6']) AS annotator) SELECT annotator, annotator IN (SELECT source FROM ann) AS produced, FALSE AS failed, annotator NOT IN (SELECT source FROM ann) AS not_produced FROM s",
    "a05_document_annotations": _A + """, s AS (SELECT document_id, unnest(['a1', 'a2', 'a3', 'a4', 'a5', 'a6']) AS name FROM docs),
c AS (SELECT s.*, count(ann.source) AS n FROM s LEFT JOIN ann ON ann.document_id = s.document_id AND ann.source = s.name GROUP BY ALL),
t AS (SELECT document_id, string_agg(name, '|' ORDER BY name) AS sources, string_agg(name || ':' || CASE WHEN n > 0 THEN 'produced_annotations' ELSE 'no_annotations' END || ':' || n, '|' ORDER BY name) AS statuses FROM c GROUP BY ALL),
i AS (SELECT document_id, count(*) AS annotation_count, string_agg(annotation_id, '|' ORDER BY source_rank, ordinal) AS annotation_ids FROM ann WHERE entity_type = 'disease' GROUP BY ALL)
SELECT t.*, coalesce(annotation_count, 0) AS annotation_count, coalesce(annotation_ids, '') AS annotation_ids FROM t LEFT JOIN i USING (document_id)""",
    "a06_ingestion_summary": f"WITH {X.SQL_DOCUMENTS} SELECT count(*) AS document_count, count(*) FILTER (WHERE pmid <> '') AS with_pmid, CAST(0 AS BIGINT) AS with_pmcid FROM docs",
    "j06_attach_document": _A + " SELECT ann.document_id, annotation_id, ordinal, pmid, title FROM ann JOIN docs USING (doc_id)",
    "j07_resolve_annotation_ids": _A + _GROUPS + ' SELECT m.document_id, nk AS normalized_keyword, start_ AS start, end_ AS "end", lasta.annotation_id, lasta.source, lasta.canonical_id FROM (SELECT document_id, nk, start_, end_, unnest(string_split(annotation_ids, \'|\')) AS annotation_id FROM m) m JOIN lasta USING (document_id, annotation_id)',
    "k01_annotations_table": _A + _KEYS + " SELECT k.document_id, pmid, title, k.source, span_text, start_ AS start, end_ AS \"end\", entity_type, annotation_id, array_to_string(cids, '|') AS canonical_id, CAST(NULL AS VARCHAR) AS canonical_name, round(confidence, 6) AS confidence FROM k JOIN docs USING (doc_id)",
    "k02_keywords_table": _A + _GROUPS + """, f AS (SELECT *, row_number() OVER (PARTITION BY document_id, nk ORDER BY start_, end_) AS n FROM m)
SELECT groups.document_id, pmid, title, keyword, f.start_ AS start, f.end_ AS "end", groups.annotation_count, groups.annotator_count, labels, canonical_ids, sources
FROM groups JOIN docs USING (document_id) JOIN f ON f.document_id = groups.document_id AND f.nk = groups.nk AND f.n = 1""",
    "k03_keyword_evidence": _A + _GROUPS + """ SELECT m.document_id, pmid, title, keyword, m.start_ AS start, m.end_ AS "end", lasta.source, lasta.entity_type AS label, lasta.annotation_id, lasta.cid AS canonical_id, CAST(NULL AS VARCHAR) AS canonical_name, round(lasta.confidence, 6) AS confidence
FROM (SELECT document_id, nk, start_, end_, unnest(string_split(annotation_ids, '|')) AS annotation_id FROM m) m JOIN lasta USING (document_id, annotation_id) JOIN (SELECT document_id, nk, keyword FROM g) g USING (document_id, nk) JOIN docs USING (document_id)""",
}
