"""Queries of reports, document merging, identifiers and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import text as T
from ..functions import vocab as V
from ..operators import agreement as G
from ..operators import merge as D
from ..operators import report_stats as R
from . import fixtures as X


def a13_bioconcept_stats(spark, d):
    return R.bioconcept_stats(X.annotations(spark, d))


def a13_bioconcept_stats_by_document(spark, d):
    return R.bioconcept_stats(X.annotations(spark, d, dealt=X.partitions(spark, d)), scope="document")


def a14_type_histogram(spark, d):
    return R.type_histogram(X.annotations(spark, d))


def a15_documents_overview(spark, d):
    return R.documents_overview(X.annotations(spark, d), X.documents(spark, d))


def a16_annotator_comparison(spark, d):
    df = R.annotator_comparison(X.annotations(spark, d, dealt=X.partitions(spark, d)), dealt=True).withColumn("hit", F.explode("hits"))
    return df.select("document_id", "key", "keyword", "first_offset", "annotator_count", "hit.source", "hit.entity_type", "hit.canonical_id", "hit.mentions", F.round("hit.confidence", 6).alias("confidence"))


def w02_non_overlapping_spans(spark, d):
    columns = ["document_id", "annotation_id", "source", "start", "end", "source_rank", "ordinal"]
    return R.non_overlapping_spans(X.annotations(spark, d, dealt=X.partitions(spark, d), columns=columns), {"a3": 0, "a1": 1, "a2": 2}, dealt=True)


def _sources(spark, d):
    """The documents as three sources see them: blank titles, blank abstracts and gaps differ."""
    docs = X.documents(spark, d)
    out = None
    for i, name in enumerate(("s1", "s2", "s3")):
        k = (F.col("doc_id") + i)
        df = docs.where(k % 5 != 0).select(
            "document_id", F.when(k % 7 != 0, F.col("pmid")).alias("pmid"), F.when(k % 3 == 0, "  ").otherwise(F.concat(F.col("title"), F.lit(f" {i}"))).alias("title"), F.when(k % 4 == 0, "").otherwise(F.col("abstract")).alias("abstract"),
            F.when(k % 6 == 0, F.col("text")).alias("full_text"), F.lit(name).alias("source"), F.when(k % 2 == 0, "2020").alias("year"),
            F.create_map(F.lit("origin_sources"), F.lit(name), F.lit(f"k{i}"), F.lit(name), F.lit("shared"), F.lit(name)).alias("metadata"), F.lit(name).alias("origin"),
        )
        out = df if out is None else out.unionByName(df)
    return out


def a01_merge_documents(spark, d):
    m = D.merge_documents(_sources(spark, d), ["s2", "s1", "s2", "s3"])
    return m.select("document_id", "pmid", "title", F.md5("abstract").alias("abstract_md5"), F.length("full_text").alias("full_text_chars"), "source", "year", F.array_join("origin_sources", "|").alias("origin_sources"),
                    F.array_join(F.array_sort(F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|").alias("metadata"))


def j09_fallback_fill(spark, d):
    s = _sources(spark, d)
    primary = s.where("source = 's1'").withColumns({"abstract": F.when(F.col("title") == "  ", "").otherwise(F.col("abstract")), "full_text": F.when(F.col("title") != "  ", F.col("full_text"))})
    df = D.fallback_fill(primary, s.where("source = 's2'"), X.documents(spark, d).select("pmid"))
    return df.select("document_id", "pmid", "title", F.length("abstract").alias("abstract_chars"), "source", "filled")


def u03_missing_ids(spark, d):
    return D.missing_ids(X.documents(spark, d), _sources(spark, d).where("source = 's3'"))


def p23_project_fields(spark, d):
    df = D.project_fields(_sources(spark, d), ["title", "year", "shared"], ["title", "abstract", "year", "full_text", "shared"], always=("pmid",))
    return df.select("document_id", "source", "title", "abstract", "year", "full_text", F.array_join(F.map_keys("metadata"), "|").alias("keys"))


def _ids(spark, d):
    e = X.table(spark, d, "events")
    k = F.col("event_id")
    raw = F.when(k % 11 == 0, " ").when(k % 3 == 0, F.concat(F.lit(" PMID:"), F.col("user_id"), F.lit(" "))).otherwise(F.concat(F.lit("pmid: "), F.col("user_id")))
    return e.select(k.alias("position"), raw.alias("raw"))


def p01_normalize_pmid(spark, d):
    ids = _ids(spark, d).withColumn("pmid", I.normalize_pmid("raw"))
    return D.first_occurrences(ids, "pmid", "position")


def p02_normalize_pmcid(spark, d):
    e = X.table(spark, d, "events").select("event_id")
    k = F.col("event_id").cast("string")
    raw = F.concat(F.element_at(F.array(F.lit("pmc:"), F.lit("PMC"), F.lit(" "), F.lit("x")), (F.col("event_id") % 4 + 1).cast("int")), k)
    return e.select("event_id", raw.alias("raw")).withColumn("pmcid", I.normalize_pmcid("raw"))


def p27_request_batches(spark, d):
    ids = _ids(spark, d).withColumn("pmid", I.normalize_pmid("raw"))
    return D.request_batches(ids, "pmid", "position").select("batch", F.size("ids").alias("n"), F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def p26_date_windows(spark, d):
    e = X.table(spark, d, "events")
    n = e.count()
    cap = max(1, n // 10)
    labelled = D.label_windows(e, "ts", D.plan_date_windows(e, "ts", cap))
    return labelled.groupBy("window_start", "window_end").agg(F.count("*").alias("n")).select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), F.date_format("window_end", "yyyy-MM-dd").alias("window_end"), "n")


def p25_partial_date(spark, d):
    e = X.table(spark, d, "events").select("event_id", "ts")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy/MM")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    df = e.select("event_id", text.alias("text"))
    return df.select("event_id", "text", D.partial_date("text").cast("string").alias("low"), D.partial_date("text", upper=True).cast("string").alias("high"))


def _span_text(spark, d):
    """Whole words of documents with signs around them, for the trimming rules."""
    docs = X.documents(spark, d).select("document_id", F.posexplode(F.split("text", "\\. ")).alias("pos", "piece"))
    return docs.withColumn("span", F.concat(F.element_at(F.array(F.lit("("), F.lit(" "), F.lit("the "), F.lit("")), (F.col("pos") % 4 + 1).cast("int")), "piece", F.lit(".) ")))


def p09_trim_boundary(spark, d):
    span, start, end = T.trim_boundary(F.col("span"), F.col("pos") * 1000)
    return _span_text(spark, d).select("document_id", "pos", F.md5(span).alias("span_md5"), start.alias("start"), end.alias("end"))


def p10_strip_determiner(spark, d):
    rest, start = T.strip_determiner(F.col("span"), F.col("pos") * 1000)
    return _span_text(spark, d).select("document_id", "pos", F.md5(rest).alias("span_md5"), start.alias("start"))


def _tokens(spark, d):
    return X.documents(spark, d).select("document_id", F.posexplode(F.split("text", "[ \\n]")).alias("pos", "token"))


def p11_noise_filter(spark, d):
    return _tokens(spark, d).where(T.is_noise(F.col("token"))).groupBy("token").agg(F.count("*").alias("n"))


def p12_outside_label_filter(spark, d):
    df = _tokens(spark, d).withColumn("label", F.when(F.col("pos") % 4 == 0, " o ").when(F.col("pos") % 4 == 1, "0").when(F.col("pos") % 4 == 2, "GENE"))
    return df.where(~T.is_outside("label")).groupBy("document_id").agg(F.count("*").alias("n"))


def p04_normalize_entity_type(spark, d):
    t = F.element_at(F.array(*map(F.lit, ("Gene / protein", "DISEASE_DISORDER", " Chemical ", "SIGN_SYMPTOM", "Multi-tissue structure", "", "CellLine", "Organism"))), (F.col("event_id") % 8 + 1).cast("int"))
    return X.table(spark, d, "events").select("event_id", t.alias("label"), V.normalize_entity_type(t).alias("entity_type"))


def _odd_ids(spark, d):
    k = F.col("event_id")
    forms = F.array(F.concat(F.lit("mesh:D"), k), F.concat(F.lit("NCBI_Gene:"), k), k.cast("string"), F.concat(F.lit("CVCL:"), k), F.concat(F.lit("cl:"), k), F.lit("-"), F.lit("CUI-less"), F.concat(F.lit("x:"), k), F.concat(F.lit("MIM:"), k))
    kind = F.element_at(F.array(F.lit("gene"), F.lit("species"), F.lit("disease")), (k % 3 + 1).cast("int"))
    return X.table(spark, d, "events").select("event_id", F.element_at(forms, (k % 9 + 1).cast("int")).alias("id"), kind.alias("kind"))


def p20_format_identifier(spark, d):
    return _odd_ids(spark, d).withColumn("shown", I.format_identifier("id", "kind"))


def p21_database_link(spark, d):
    return _odd_ids(spark, d).withColumn("link", I.database_link("id", "kind"))


def p22_real_identifier(spark, d):
    return _odd_ids(spark, d).withColumn("real_id", I.real_identifier("id"))


def p08_normalize_identifier(spark, d):
    return X.annotations(spark, d).select("document_id", "annotation_id", "ordinal", F.coalesce(I.joined_identifiers("canonical_id"), F.lit("")).alias("ids"))


def _requests(spark, d):
    e = X.table(spark, d, "events")
    names = [*V.ANNOTATORS, "unknown"]
    kinds = ("Gene", "disease", "problem", "Cell type", "organ")
    at = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (k + 1).cast("int"))
    return e.select("event_id", at(names, F.col("event_id") % len(names)).alias("annotator"), at(kinds, F.floor(F.col("event_id") / len(names)) % len(kinds)).alias("entity_type"))


def p28_normalization_databases(spark, d):
    return V.normalization_databases(_requests(spark, d)).withColumn("databases", F.array_join("databases", "|"))


def p28_annotator_capabilities(spark, d):
    known = V.annotator_capabilities(spark).select("annotator", F.array_join("tasks", "|").alias("tasks"), "normalization_status", F.array_join("normalization_fields", "|").alias("fields"))
    return _requests(spark, d).select("event_id", "annotator").join(known, "annotator", "left")


def p28_type_choices(spark, d):
    asked = X.table(spark, d, "events").select("user_id", F.element_at(F.array(*map(F.lit, V.ANNOTATORS)), (F.col("event_id") % len(V.ANNOTATORS) + 1).cast("int")).alias("annotator"))
    return V.type_choices_of(asked, "user_id").withColumn("choices", F.array_join("choices", "|"))


def u02_distinct_ordered(spark, d):
    tokens = F.transform(F.split("text", "[ \\n]"), F.lower)
    return X.documents(spark, d).select("document_id", F.md5(F.array_join(D.distinct_ordered(tokens), " ")).alias("tokens_md5"), F.size(D.distinct_ordered(tokens)).alias("n"))


def j10_unsupported_types(spark, d):
    return V.unsupported_types(_requests(spark, d)).groupBy("annotator", "entity_type").agg(F.count("*").alias("n"))


def p24_sources_for_field(spark, d):
    known = _sources(spark, d).select("source", F.explode(F.map_keys("metadata")).alias("field")).distinct()
    return D.sources_for_field(known, "k1")


def x01_agreement_groups(spark, d):
    return G.agreement_groups(X.annotations(spark, d, dealt=X.partitions(spark, d)), len(X.ANNOTATORS), dealt=True).select("document_id", "entity_type", "start", "end", "support_count", F.round("support_fraction", 6).alias("support_fraction"), F.array_join("annotators", "|").alias("annotators"), F.size("member_ids").alias("members"))


def x02_merge_candidates(spark, d):
    return G.merge_candidates(X.annotations(spark, d, columns=["document_id", "source", "start", "end", "entity_type"])).select("document_id", "start", "end", F.array_join("entity_types", "|").alias("entity_types"), F.array_join("sources", "|").alias("sources"))


def x03_crosswalk_identifiers(spark, d):
    h = F.col("h")
    lexicon = X.spans(spark, d).select(h).distinct().select(F.concat(F.lit("C"), h).alias("concept_id"), F.explode(F.array(F.concat(F.lit("MESH:D"), h), F.concat(F.lit("OMIM:"), h))).alias("identifier"))
    return G.crosswalk_identifiers(X.annotations(spark, d), lexicon).select("document_id", "annotation_id", "ordinal", F.array_join("concept_ids", "|").alias("concept_ids"))


def x04_relation_candidates(spark, d):
    n = X.partitions(spark, d)
    a = X.annotations(spark, d, dealt=n, columns=["document_id", "start", "end", "entity_type", "annotation_id"])
    types = spark.createDataFrame([("drug", "disease")], "type_a string, type_b string")
    return G.relation_candidates(a, X.documents(spark, d), types, dealt=n).groupBy("document_id", "sentence").agg(F.count("*").alias("pairs"))


def x05_entity_score(spark, d):
    g = G.agreement_groups(X.annotations(spark, d, dealt=X.partitions(spark, d)), len(X.ANNOTATORS), dealt=True)
    df = g.select("document_id", "entity_type", "start", "end", F.col("support_fraction").alias("agreement"), (F.size("member_ids") % 2).cast("double").alias("ontology"), F.lit(0.5).alias("llm"), F.lit(1.0).alias("type_consistency"))
    return df.withColumn("score", F.round(G.entity_score("agreement", "ontology", "llm", "type_consistency"), 6)).select("document_id", "entity_type", "start", "end", "score")


QUERIES = {k: v for k, v in list(globals().items()) if k[0] in "apjuwx" and k[1:3].isdigit() and callable(v)}

_A = "WITH " + X.SQL_PREDICTIONS
_D = "WITH " + X.SQL_DOCUMENTS
FOLD = "replace(replace(lower(span_text), 'ß', 'ss'), 'ς', 'σ')"
_STATS = _A + """, k AS (SELECT *, {fold} AS key, source_rank * 10000000 + ordinal AS o FROM ann WHERE span_text <> ''),
q AS (SELECT entity_type AS type, key, {place}, arg_min(span_text, struct_pack(d := document_id, o := o)) AS keyword, min(struct_pack(d := document_id, o := o)) AS o FROM k GROUP BY ALL),
w AS (SELECT type, key, arg_min(keyword, o) AS keyword, count(*) AS mentions FROM q GROUP BY ALL),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY mentions DESC, key) AS INTEGER) AS rank, CAST(sum(mentions) OVER (PARTITION BY type) AS BIGINT) AS type_total, count(*) OVER (PARTITION BY type) AS n FROM w)
SELECT type, rank, keyword, mentions, type_total, greatest(n - 15, 0) AS remaining FROM t WHERE rank <= 15"""


def _source(i: int, name: str) -> str:
    k = f"(doc_id + {i})"
    return (f"SELECT doc_id, document_id, CASE WHEN {k} % 7 <> 0 THEN pmid END AS pmid, CASE WHEN {k} % 3 = 0 THEN '  ' ELSE title || ' {i}' END AS title, CASE WHEN {k} % 4 = 0 THEN '' ELSE abstract END AS abstract, "
            f"CASE WHEN {k} % 6 = 0 THEN text END AS full_text, '{name}' AS source, CASE WHEN {k} % 2 = 0 THEN '2020' END AS year, {i} AS i FROM docs WHERE {k} % 5 <> 0")  # fmt: skip


_S = _D + ", src AS (" + " UNION ALL ".join(_source(i, f"s{i + 1}") for i in range(3)) + "), pr AS (SELECT *, CASE i WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS rk FROM src)"
_IDS = "WITH raw AS (SELECT event_id AS position, CASE WHEN event_id % 11 = 0 THEN ' ' WHEN event_id % 3 = 0 THEN ' PMID:' || user_id || ' ' ELSE 'pmid: ' || user_id END AS raw FROM events), ids AS (SELECT position, nullif(trim(regexp_replace(trim(raw), '(?i)^PMID:', '')), '') AS pmid FROM raw), once AS (SELECT pmid, min(position) AS position FROM ids WHERE pmid IS NOT NULL GROUP BY pmid)"
_ODD = "WITH o AS (SELECT event_id, (['mesh:D' || event_id, 'NCBI_Gene:' || event_id, '' || event_id, 'CVCL:' || event_id, 'cl:' || event_id, '-', 'CUI-less', 'x:' || event_id, 'MIM:' || event_id])[event_id % 9 + 1] AS id, (['gene', 'species', 'disease'])[event_id % 3 + 1] AS kind FROM events)"
_PIECES = _D + """, pc AS (SELECT document_id, unnest(string_split(text, '. ')) AS piece, generate_subscripts(string_split(text, '. '), 1) - 1 AS pos FROM docs),
s AS (SELECT document_id, CAST(pos AS INTEGER) AS pos, (['(', ' ', 'the ', ''])[pos % 4 + 1] || piece || '.) ' AS span FROM pc)"""
_NAMES = "[" + ", ".join(f"'{a}'" for a in [*V.ANNOTATORS, "unknown"]) + "]"
_REQUESTS = f"WITH r AS (SELECT event_id, ({_NAMES})[event_id % {len(V.ANNOTATORS) + 1} + 1] AS annotator, (['Gene', 'disease', 'problem', 'Cell type', 'organ'])[(event_id // {len(V.ANNOTATORS) + 1}) % 5 + 1] AS entity_type FROM events), c AS (SELECT *, (['gene', 'disease', 'problem', 'cell_type', 'organ'])[(event_id // {len(V.ANNOTATORS) + 1}) % 5 + 1] AS t FROM r), specs(annotator, t, dbs) AS (VALUES " + ", ".join(f"('{a}', '{t[1]}', '{'|'.join(t[2:])}')" for a, (_, types) in V.ANNOTATORS.items() for t in {x[1]: x for x in reversed(types)}.values()) + ")"
_BASE = "CASE split_part(lower(id), ':', 1) WHEN 'mesh' THEN 'https://meshb.nlm.nih.gov/record/ui?ui=' || rest WHEN 'ncbi_gene' THEN 'https://www.ncbi.nlm.nih.gov/gene/' || rest WHEN 'cvcl' THEN 'https://www.cellosaurus.org/CVCL_' || rest WHEN 'cl' THEN 'https://purl.obolibrary.org/obo/CL_' || rest WHEN 'mim' THEN 'https://www.omim.org/entry/' || rest END"

_FITS = "(" + ", ".join(f"'{a}'" for a in V.NORMALIZING) + ")"
_CHOICE = "[" + ", ".join(f"'{t}'" for t in V.CHOICES) + "]"

ORACLE_SQL = {
    "p28_annotator_capabilities": _REQUESTS + f", f(annotator, fields) AS (VALUES {', '.join(f"('{a}', '{'|'.join(x)}')" for a, x in V.NORMALIZING.items())})" + f""" SELECT event_id, c.annotator, CASE WHEN c.annotator = 'unknown' THEN NULL WHEN c.annotator IN {_FITS} THEN 'NER|NEN' ELSE 'NER' END AS tasks,
  CASE WHEN c.annotator = 'unknown' THEN NULL WHEN c.annotator IN {_FITS} THEN 'normalized' ELSE 'not_returned' END AS normalization_status, CASE WHEN c.annotator <> 'unknown' THEN coalesce(fields, '') END AS fields FROM c LEFT JOIN f ON f.annotator = c.annotator""",
    "p28_type_choices": _REQUESTS + f""", u AS (SELECT DISTINCT user_id, ({_NAMES})[event_id % {len(V.ANNOTATORS)} + 1] AS annotator FROM events),
t AS (SELECT DISTINCT user_id, t FROM u JOIN specs USING (annotator)), k AS (SELECT user_id, t, coalesce(nullif(list_position({_CHOICE}, t), 0), 999) AS place FROM t)
SELECT DISTINCT u.user_id, coalesce(c.choices, '') AS choices FROM u LEFT JOIN (SELECT user_id, string_agg(t, '|' ORDER BY place, t) AS choices FROM k GROUP BY ALL) c USING (user_id)""",
    "u02_distinct_ordered": _D + r""", t AS (SELECT document_id, unnest(string_split_regex(text, '[ \n]')) AS token, generate_subscripts(string_split_regex(text, '[ \n]'), 1) AS pos FROM docs),
o AS (SELECT document_id, lower(token) AS token, min(pos) AS pos FROM t WHERE trim(token, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY ALL), g AS (SELECT document_id, md5(string_agg(token, ' ' ORDER BY pos)) AS tokens_md5, count(*) AS n FROM o GROUP BY ALL)
SELECT docs.document_id, coalesce(tokens_md5, md5('')) AS tokens_md5, CAST(coalesce(n, 0) AS INTEGER) AS n FROM docs LEFT JOIN g USING (document_id)""",
    "w02_non_overlapping_spans": _A + """, k AS MATERIALIZED (SELECT document_id, annotation_id, source, start_, end_, row_number() OVER (PARTITION BY document_id ORDER BY start_, CASE source WHEN 'a3' THEN 0 WHEN 'a1' THEN 1 WHEN 'a2' THEN 2 ELSE 99 END, start_ - end_, source_rank, ordinal, annotation_id) AS o FROM ann WHERE end_ > start_),
c AS (SELECT *, max(end_) OVER (PARTITION BY document_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM k),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY o) AS chain FROM c),
f AS (SELECT document_id, list_reduce(list_prepend([CAST(-1 AS BIGINT)], list([CAST(start_ AS BIGINT), end_, o] ORDER BY o)), lambda a, x: CASE WHEN x[1] >= a[1] THEN list_append(list_prepend(x[2], a[2:]), x[3]) ELSE a END) AS kept FROM n GROUP BY document_id, chain),
u AS (SELECT document_id, unnest(kept[2:]) AS o FROM f)
SELECT document_id, annotation_id, source, start_ AS start, end_ AS "end" FROM k JOIN u USING (document_id, o)""",
    "p26_date_windows": """WITH RECURSIVE days AS (SELECT CAST(ts AS DATE) AS d, count(*) AS c FROM events WHERE ts IS NOT NULL GROUP BY ALL), most AS (SELECT greatest(1, (SELECT count(*) FROM events) // 10) AS cap),
w AS (SELECT min(d) AS lo, max(d) AS hi, CAST(sum(c) AS BIGINT) AS n FROM days
  UNION ALL SELECT s.lo, s.hi, CAST((SELECT coalesce(sum(c), 0) FROM days WHERE d BETWEEN s.lo AND s.hi) AS BIGINT) AS n
  FROM (SELECT CASE half WHEN 0 THEN lo ELSE lo + CAST((hi - lo) // 2 + 1 AS INTEGER) END AS lo, CASE half WHEN 0 THEN lo + CAST((hi - lo) // 2 AS INTEGER) ELSE hi END AS hi FROM w, most, (VALUES (0), (1)) AS h(half) WHERE n > cap) s)
SELECT strftime(lo, '%Y-%m-%d') AS window_start, strftime(hi, '%Y-%m-%d') AS window_end, n FROM w, most WHERE n <= cap AND n > 0""",
    "x04_relation_candidates": _A + r""", pc AS (SELECT document_id, unnest(string_split_regex(text, '[.!?][ \t\n\x0B\f\r]')) AS piece, generate_subscripts(string_split_regex(text, '[.!?][ \t\n\x0B\f\r]'), 1) - 1 AS sentence FROM docs),
st AS (SELECT document_id, sentence, CAST(coalesce(sum(length(piece) + 2) OVER (PARTITION BY document_id ORDER BY sentence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at FROM pc),
pl AS (SELECT DISTINCT document_id, start_, end_, entity_type FROM ann WHERE entity_type IN ('drug', 'disease')),
q AS (SELECT pl.*, st.sentence FROM pl ASOF JOIN st ON pl.document_id = st.document_id AND pl.start_ >= st.at),
c AS (SELECT document_id, sentence, count(*) FILTER (WHERE entity_type = 'drug') AS a, count(*) FILTER (WHERE entity_type = 'disease') AS b FROM q GROUP BY ALL)
SELECT document_id, CAST(sentence AS INTEGER) AS sentence, a * b AS pairs FROM c WHERE a * b > 0""",
    "a13_bioconcept_stats": _STATS.replace("{fold}", FOLD).replace("{place}", "start_, end_"),
    "a13_bioconcept_stats_by_document": _STATS.replace("{fold}", FOLD).replace("{place}", "start_, end_, document_id"),
    "a14_type_histogram": _A + " SELECT entity_type AS type, count(*) AS annotation_count FROM ann GROUP BY ALL",
    "a15_documents_overview": _A + """, c AS (SELECT document_id, entity_type AS type, count(*) AS n FROM ann GROUP BY ALL), x AS (SELECT docs.document_id, type, coalesce(n, 0) AS type_count FROM docs LEFT JOIN c USING (document_id)),
y AS (SELECT *, CAST(sum(type_count) OVER (PARTITION BY document_id) AS BIGINT) AS total FROM x) SELECT *, CASE WHEN total > 0 THEN round(100.0 * type_count / total, 2) ELSE 0.0 END AS share FROM y""",
    "a16_annotator_comparison": _A + f""", k AS (SELECT *, {FOLD} AS key, source_rank * 10000000 + ordinal AS o FROM ann WHERE span_text <> ''),
h AS (SELECT document_id, key, source, entity_type, canonical_id, count(*) AS mentions, round(max(confidence), 6) AS confidence FROM k GROUP BY ALL),
g AS (SELECT document_id, key, arg_min(span_text, o) AS keyword, min(start_) AS first_offset, count(DISTINCT source) AS annotator_count FROM k GROUP BY ALL) SELECT * FROM g JOIN h USING (document_id, key)""",
    "a01_merge_documents": _S + """, md AS (SELECT document_id, 'k' || i AS k, source AS v, rk FROM pr UNION ALL SELECT document_id, 'shared', source, rk FROM pr),
mk AS (SELECT document_id, k, arg_min(v, rk) AS v FROM md GROUP BY ALL), mm AS (SELECT document_id, string_agg(k || '=' || v, '|' ORDER BY k) AS metadata FROM mk GROUP BY ALL)
SELECT document_id, arg_min(pmid, rk) FILTER (WHERE pmid <> '') AS pmid, coalesce(arg_min(title, rk) FILTER (WHERE trim(title) <> ''), '') AS title, md5(coalesce(arg_min(abstract, rk) FILTER (WHERE trim(abstract) <> ''), '')) AS abstract_md5,
  CAST(length(arg_min(full_text, rk) FILTER (WHERE full_text <> '')) AS INTEGER) AS full_text_chars, arg_min(source, rk) AS source, arg_min(year, rk) FILTER (WHERE year <> '') AS year, string_agg(source, '|' ORDER BY rk) AS origin_sources, any_value(mm.metadata) AS metadata
FROM pr JOIN mm USING (document_id) GROUP BY document_id""",
    "j09_fallback_fill": _S + """, p AS (SELECT document_id, pmid, title, CASE WHEN title = '  ' THEN '' ELSE abstract END AS abstract, CASE WHEN title <> '  ' THEN full_text END AS full_text, source FROM src WHERE i = 0), f AS (SELECT * FROM src WHERE i = 1),
x AS (SELECT p.*, f.title AS ft, f.abstract AS fa, trim(p.title) = '' AND trim(p.abstract) = '' AND coalesce(trim(p.full_text), '') = '' AND f.pmid IS NOT NULL AS fill FROM p LEFT JOIN f ON p.pmid = f.pmid)
SELECT document_id, pmid, CASE WHEN fill AND trim(title) = '' THEN ft ELSE title END AS title, CAST(length(CASE WHEN fill AND trim(abstract) = '' THEN fa ELSE abstract END) AS INTEGER) AS abstract_chars, source, CASE WHEN fill THEN 'filled' ELSE 'kept' END AS filled FROM x
UNION ALL SELECT document_id, pmid, title, CAST(length(abstract) AS INTEGER), source, 'appended' FROM f WHERE pmid IS NOT NULL AND pmid NOT IN (SELECT pmid FROM p WHERE pmid IS NOT NULL)""",
    "u03_missing_ids": _S + " SELECT pmid FROM docs WHERE pmid NOT IN (SELECT pmid FROM src WHERE i = 2 AND pmid IS NOT NULL)",
    "p23_project_fields": _S + " SELECT document_id, source, title, '' AS abstract, year, CAST(NULL AS VARCHAR) AS full_text, 'shared' AS keys FROM src",
    "p01_normalize_pmid": _IDS + " SELECT * FROM once",
    "p02_normalize_pmcid": "WITH r AS (SELECT event_id, (['pmc:', 'PMC', ' ', 'x'])[event_id % 4 + 1] || event_id AS raw FROM events) SELECT *, CASE WHEN raw LIKE 'x%' THEN NULL ELSE 'PMC' || event_id END AS pmcid FROM r",
    "p27_request_batches": _IDS + ", n AS (SELECT *, row_number() OVER (ORDER BY position) - 1 AS i, count(*) OVER () AS total FROM once) SELECT CASE WHEN total <= 100 THEN 0 ELSE i // 1000 END AS batch, CAST(count(*) AS INTEGER) AS n, md5(string_agg(pmid, ',' ORDER BY i)) AS ids_md5 FROM n GROUP BY 1",
    "p25_partial_date": """WITH e AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y') WHEN 1 THEN strftime(ts, '%Y/%m') ELSE strftime(ts, '%Y-%m-%d') END AS text, ts FROM events)
SELECT event_id, text, strftime(CASE event_id % 3 WHEN 0 THEN date_trunc('year', ts) WHEN 1 THEN date_trunc('month', ts) ELSE ts END, '%Y-%m-%d') AS low,
  strftime(CASE event_id % 3 WHEN 0 THEN make_date(CAST(year(ts) AS BIGINT), 12, 31) WHEN 1 THEN last_day(ts) ELSE CAST(ts AS DATE) END, '%Y-%m-%d') AS high FROM e""",
    "p09_trim_boundary": _PIECES + r""", b AS (SELECT *, regexp_replace(span, '^[\s.,;:!?()\[\]{}"'']+|[\s.,;:!?()\[\]{}"'']+$', '', 'g') AS bare, length(regexp_extract(span, '^[\s.,;:!?()\[\]{}"'']*')) AS lead FROM s)
SELECT document_id, pos, md5(bare) AS span_md5, CAST(pos * 1000 + CASE WHEN bare = '' THEN 0 ELSE lead END AS INTEGER) AS start, CAST(pos * 1000 + CASE WHEN bare = '' THEN 0 ELSE lead END + length(bare) AS INTEGER) AS "end" FROM b""",
    "p10_strip_determiner": _PIECES + ", b AS (SELECT *, regexp_replace(span, '(?i)^(these|those|this|the|an|a) +', '') AS bare FROM s) SELECT document_id, pos, md5(bare) AS span_md5, CAST(pos * 1000 + length(span) - length(bare) AS INTEGER) AS start FROM b",
    "p11_noise_filter": _D + r", t AS (SELECT unnest(string_split_regex(text, '[ \n]')) AS token FROM docs), b AS (SELECT token, regexp_replace(token, '^[-/ \t]+|[-/ \t]+$', '', 'g') AS bare FROM t) SELECT token, count(*) AS n FROM b WHERE length(bare) < 2 OR NOT regexp_matches(bare, '[\p{L}\p{N}]') OR lower(bare) IN ('these', 'those', 'this', 'the', 'an', 'a') GROUP BY ALL",
    "p12_outside_label_filter": _D + r", t AS (SELECT document_id, unnest(string_split_regex(text, '[ \n]')) AS token, generate_subscripts(string_split_regex(text, '[ \n]'), 1) - 1 AS pos FROM docs) SELECT document_id, count(*) AS n FROM t WHERE pos % 4 = 2 GROUP BY ALL",
    "p04_normalize_entity_type": "SELECT event_id, (['Gene / protein', 'DISEASE_DISORDER', ' Chemical ', 'SIGN_SYMPTOM', 'Multi-tissue structure', '', 'CellLine', 'Organism'])[event_id % 8 + 1] AS label, (['gene', 'disease', 'drug', 'sign_symptom', 'multi_tissue_structure', 'unknown', 'cell_line', 'species'])[event_id % 8 + 1] AS entity_type FROM events",
    "p20_format_identifier": _ODD + " SELECT *, CASE event_id % 9 WHEN 0 THEN 'MESH:D' || event_id WHEN 1 THEN 'NCBIGene:' || event_id WHEN 2 THEN CASE kind WHEN 'gene' THEN 'NCBIGene:' || event_id WHEN 'species' THEN 'NCBITaxon:' || event_id ELSE id END WHEN 4 THEN 'CL:' || event_id WHEN 8 THEN 'OMIM:' || event_id ELSE id END AS shown FROM o",
    "p21_database_link": _ODD + f", r AS (SELECT *, substr(id, strpos(id, ':') + 1) AS rest FROM o) SELECT event_id, id, kind, CASE WHEN contains(id, ':') THEN {_BASE} WHEN regexp_full_match(id, '\\d+') AND kind = 'gene' THEN 'https://www.ncbi.nlm.nih.gov/gene/' || id WHEN regexp_full_match(id, '\\d+') AND kind = 'species' THEN 'https://www.ncbi.nlm.nih.gov/taxonomy/' || id END AS link FROM r",
    "p22_real_identifier": _ODD + " SELECT *, CASE WHEN lower(trim(id)) NOT IN ('cui-less', '-', '') THEN id END AS real_id FROM o",
    "p08_normalize_identifier": _A + " SELECT document_id, annotation_id, ordinal, CASE WHEN canonical_id IS NULL THEN '' WHEN canonical_id LIKE '[%' THEN replace(replace(substr(canonical_id, 2, length(canonical_id) - 2), '''', ''), ', ', '|') WHEN lower(canonical_id) LIKE 'mesh:%' THEN 'MESH:' || substr(canonical_id, 6) ELSE canonical_id END AS ids FROM ann",
    "p28_normalization_databases": _REQUESTS + " SELECT event_id, c.annotator, c.entity_type, CASE WHEN c.t = 'problem' THEN '' ELSE coalesce(dbs, '') END AS databases FROM c LEFT JOIN specs ON specs.annotator = c.annotator AND specs.t = c.t",
    "j10_unsupported_types": _REQUESTS + " SELECT c.annotator, c.entity_type, count(*) AS n FROM c ANTI JOIN specs ON specs.annotator = c.annotator AND specs.t = c.t GROUP BY ALL",
    "p24_sources_for_field": _S + " SELECT DISTINCT source FROM src WHERE i = 1",
    "x01_agreement_groups": _A + """, o AS (SELECT *, max(end_) OVER (PARTITION BY doc_id, entity_type ORDER BY start_, end_, source_rank, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ann),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, entity_type ORDER BY start_, end_, source_rank, ordinal) AS g FROM o)
SELECT document_id, entity_type, min(start_) AS start, max(end_) AS "end", count(DISTINCT source) AS support_count, round(count(DISTINCT source) / 5.0, 6) AS support_fraction, string_agg(DISTINCT source, '|' ORDER BY source) AS annotators, CAST(count(DISTINCT annotation_id) AS INTEGER) AS members FROM n GROUP BY document_id, entity_type, g""",
    "x02_merge_candidates": _A + ' SELECT document_id, start_ AS start, end_ AS "end", string_agg(DISTINCT entity_type, \'|\' ORDER BY entity_type) AS entity_types, string_agg(DISTINCT source, \'|\' ORDER BY source) AS sources FROM ann GROUP BY ALL',
    "x03_crosswalk_identifiers": _A + ", c AS (SELECT *, regexp_extract(canonical_id, '[:D](\\d+)', 1) AS num FROM ann) SELECT document_id, annotation_id, ordinal, CASE WHEN canonical_id IS NULL THEN '' ELSE 'C' || num END AS concept_ids FROM c",
    "x05_entity_score": _A + """, o AS (SELECT *, max(end_) OVER (PARTITION BY doc_id, entity_type ORDER BY start_, end_, source_rank, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ann),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, entity_type ORDER BY start_, end_, source_rank, ordinal) AS g FROM o)
SELECT document_id, entity_type, min(start_) AS start, max(end_) AS "end", round(0.30 * count(DISTINCT source) / 5.0 + 0.25 * (count(DISTINCT annotation_id) % 2) + 0.25 * 0.5 + 0.20, 6) AS score FROM n GROUP BY document_id, entity_type, g""",
}
