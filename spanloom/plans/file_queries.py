"""Queries of file readers, file sinks, publication XML and service payloads.

The given tables hold no such files, so their rows are rendered as files in the shared folder (or as XML and
JSON columns) and read back by the operators.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..operators import keywords as K
from ..operators import sinks as W
from ..sources import files as S
from ..sources import pubmed as P
from ..sources import records as R
from . import fixtures as X
from .annotate_queries import ORACLE_SQL as _ANNOTATE_SQL
from .report_queries import _IDS, _ids

_KEYWORDS = _ANNOTATE_SQL["k02_keywords_table"]

_BLANKS = "chr(10) || chr(9) || chr(13) || ' '"


def _folder(spark) -> str:
    """A new folder that the driver and all executors see."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="rendered-")
    return f"{shared.rstrip('/')}/rendered-{uuid.uuid4().hex}"


def _one_file_each(df, path: str) -> str:
    """Each value as a file of its own."""
    df.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return path


# ---------------------------------------------------------------- files
def s01_text_table(spark, d):
    path = _folder(spark)
    docs = X.documents(spark, d).select("document_id", "title", "abstract", "lang")
    docs.write.option("header", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    df = S.read_text_table(spark, path, "csv")
    return df.select("document_id", F.length("title").alias("title_chars"), F.md5("abstract").alias("abstract_md5"), "source", F.element_at("metadata", "lang").alias("lang"))


def s02_corpus_json(spark, d):
    k = F.col("doc_id")
    record = F.struct(F.when(k % 5 != 0, F.col("document_id")).alias("document_id"), F.when(k % 7 != 0, F.col("pmid")).alias("pmid"), "title", "abstract", F.when(k % 3 == 0, " ").otherwise("corpus b").alias("source"))
    lists = X.documents(spark, d).groupBy(F.floor(k / 500).alias("file")).agg(F.array_sort(F.collect_list(F.struct("doc_id", record.alias("r")))).alias("x"))
    listed = F.to_json(F.transform("x", lambda x: x["r"]))
    value = F.when(F.col("file") % 2 == 0, listed).otherwise(F.concat(F.lit('{"documents": '), listed, F.lit("}")))
    df = S.read_corpus_json(spark, _one_file_each(lists.select(value.alias("value")), _folder(spark)))
    return df.select("document_id", "pmid", F.length("title").alias("title_chars"), "source")


def s03_id_list(spark, d):
    path = _folder(spark)
    _ids(spark, d).select(F.col("raw").alias("value")).write.text(path)
    return S.read_id_list(spark, path).groupBy("pmid").agg(F.count("*").alias("n"))


def s04_raw_text_lines(spark, d):
    path = _folder(spark)
    X.documents(spark, d).orderBy("doc_id").select(F.translate("text", "\n\r", "  ").alias("value")).write.text(path)
    return S.read_raw_text_lines(spark, path).select("document_id", F.md5("abstract").alias("abstract_md5"))


def s05_corpus_rows(spark, d):
    path = _folder(spark)
    W.write_jsonl(X.bigbio_rows(spark, d).drop("doc_id"), path, compression="gzip")
    df = S.read_bigbio_jsonl(spark, path)
    ids = F.array_join(F.transform("e.normalized", lambda x: F.concat_ws(":", x["db_name"], x["db_id"])), "|")
    rows = df.select("document_id", F.size("passages").alias("passages"), F.md5(F.to_json("passages.text")).alias("passages_md5"), F.coalesce(F.size("relations"), F.lit(0)).alias("relations"), "entities")
    rows = rows.select("document_id", "passages", "passages_md5", "relations", F.explode_outer("entities").alias("e"))  # a document's own columns are made before its entities are rows
    place = F.get("e.offsets", F.lit(0))
    return rows.select("document_id", "passages", "passages_md5", "relations", "e.id", "e.type", F.get("e.text", F.lit(0)).alias("text"), F.get(place, F.lit(0)).alias("start"), F.get(place, F.lit(1)).alias("end"), ids.alias("ids"))


def s06_iob_rows(spark, d):
    path = _folder(spark)
    W.write_jsonl(X.iob_rows(spark, d), path)
    return S.read_iob_jsonl(spark, path).select("id", F.size("tokens").alias("tokens"), F.aggregate("ner_tags", F.lit(0), lambda a, x: a + x).alias("tags"))


# ---------------------------------------------------------------- publication XML
def _xml_text(c: str):
    """Text as XML content: characters that XML does not allow are dropped, carriage returns are blanks."""
    kept = F.translate(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), "\r", " ")
    return F.replace(F.replace(F.replace(kept, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _element(name: str, *parts, attributes: str = ""):
    return F.concat(F.lit(f"<{name}{attributes}>"), *(F.lit(p) if isinstance(p, str) else p for p in parts), F.lit(f"</{name}>"))


def s16_pubmed_records(spark, d):
    """Every field of a record; arrays as JSON."""
    k, n = F.col("doc_id").cast("string"), lambda m: (F.col("doc_id") % m).cast("string")
    date = lambda name, year, month="", day="", attributes="": _element(name, f"<Year>{year}</Year>", *([f"<Month>{month}</Month>"] if month else []), *([f"<Day>{day}</Day>"] if day else []), attributes=attributes)
    journal = _element("Journal", _element("ISSN", k, attributes=' IssnType="Print"'), _element("JournalIssue", _element("Volume", n(9)), _element("Issue", n(4)), date("PubDate", 2020, 3)), "<Title>J &amp; K</Title><ISOAbbreviation>JK</ISOAbbreviation>")
    abstract = _element("Abstract", _element("AbstractText", _xml_text("abstract"), attributes=' Label="AIM" NlmCategory="OBJECTIVE"'), "<AbstractText>Second <sub>x</sub> part</AbstractText>")
    author = _element("Author", _element("LastName", "L", k), "<ForeName>F</ForeName><Initials>I</Initials>", _element("Identifier", "https://orcid.org/0-", n(7), attributes=' Source="ORCID"'), _element("AffiliationInfo", _element("Affiliation", "U", n(5))))
    authors = _element("AuthorList", author, _element("Author", "<CollectiveName>G</CollectiveName>", _element("AffiliationInfo", _element("Affiliation", "U", n(2)))))
    rest = _element("GrantList", _element("Grant", _element("GrantID", "G", k), "<Agency>A</Agency><Country>C</Country>")) , "<PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList>", _element("DataBankList", _element("DataBank", "<DataBankName>GEO</DataBankName>", _element("AccessionNumber", k)))
    article = _element("Article", journal, "<ArticleTitle><i>", _xml_text("title"), "</i></ArticleTitle><Pagination><MedlinePgn>1-2</MedlinePgn></Pagination>", abstract, authors, "<Language>eng</Language><Language>ger</Language>", *rest, date("ArticleDate", 2019, 2, 1, ' DateType="Electronic"'))
    mesh = _element("MeshHeadingList", _element("MeshHeading", _element("DescriptorName", "M", n(3), attributes=' UI="D1" MajorTopicYN="Y"'), _element("QualifierName", "q", attributes=' UI="Q1"')))
    more = "<MedlineJournalInfo><Country>UK</Country><MedlineTA>TA</MedlineTA>", _element("NlmUniqueID", n(8)), "</MedlineJournalInfo>", _element("ChemicalList", _element("Chemical", "<RegistryNumber>0</RegistryNumber>", _element("NameOfSubstance", "W", n(3), attributes=' UI="C1"')))
    names = "<SupplMeshList><SupplMeshName Type=\"Disease\" UI=\"S1\">S</SupplMeshName></SupplMeshList>", _element("GeneSymbolList", _element("GeneSymbol", "g", n(6))), mesh, _element("KeywordList", "<Keyword>k &lt;1&gt;</Keyword>", _element("Keyword", "w", n(4)))
    medline = _element("MedlineCitation", _element("PMID", k, attributes=' Version="2"'), date("DateRevised", 2021, 11, 30), article, *more, *names, attributes=' Status="MEDLINE" Owner="NLM"')
    history = _element("History", *(date("PubMedPubDate", year, month, attributes=f' PubStatus="{status}"') for status, year, month in (("received", 2018, 1), ("accepted", 2018, 12), ("medline", 2019, 4), ("entrez", 2019, 5))))
    ids = _element("ArticleIdList", *(_element("ArticleId", lead, k, attributes=f' IdType="{kind}"') for kind, lead in (("pmc", ""), ("doi", "10.1/"), ("pii", "S"))))
    cited = _element("CommentsCorrectionsList", _element("CommentsCorrections", "<RefSource>s</RefSource>", _element("PMID", n(50)), attributes=' RefType="Cites"'))
    foreign = "<ReferenceList><Reference><ArticleIdList><ArticleId IdType=\"doi\">10.9/other</ArticleId></ArticleIdList></Reference></ReferenceList>"
    whole = _element("PubmedArticle", medline, _element("PubmedData", history, cited, ids, foreign))
    sets = X.documents(spark, d).groupBy(F.floor(F.col("doc_id") / 100)).agg(F.concat(F.lit("<Set>"), F.array_join(F.collect_list(whole), "\n"), F.lit("</Set>")).alias("value"))
    df = P.pubmed_xml_to_records(P.read_pubmed_xml(spark, _one_file_each(sets.select("value"), _folder(spark))))
    df = df.withColumn("abstract_md5", F.md5("abstract")).withColumn("title_chars", F.length("title")).withColumn("structured_abstract", F.transform("structured_abstract", lambda s: s.withField("text", F.md5(s["text"]))))
    return df.select(*(F.to_json(c).alias(c) if t.startswith("array") else c for c, t in df.dtypes if c not in ("abstract", "title")))


def s18_full_text(spark, d):
    k = F.col("doc_id")
    docs = X.documents(spark, d)
    pmcid = F.when(k % 7 != 0, F.concat(F.lit("PMC"), "doc_id"))
    paragraphs = F.array_join(F.transform(F.split("abstract", "\n"), lambda p: F.concat(F.lit("<p>"), _xml_text(p), F.lit("</p>"))), "")
    xml = F.concat(F.lit("<article><front><p>no</p></front><body><sec><title>"), _xml_text("title"), F.lit("</title>"), paragraphs, F.lit("</sec></body></article>"))
    texts = docs.where(k % 5 != 0).select(F.concat(F.lit("PMC"), "doc_id").alias("pmcid"), F.when(k % 11 != 0, xml).alias("xml"))
    df = R.attach_full_text(docs.select("document_id", pmcid.alias("pmcid"), F.when(k % 2 == 0, False).alias("in_pmc")), texts)
    return df.select("document_id", "pmcid", "full_text_status", F.md5("full_text").alias("full_text_md5"))


# ---------------------------------------------------------------- service payloads
def s19_enrichment_links(spark, d):
    k = F.col("doc_id")
    link = lambda x, score: F.struct(x.cast("string").alias("id"), score.alias("score"))
    near = F.struct(F.lit("pubmed_pubmed").alias("linkname"), F.array(link(k + 1, k % 10), link(k + 2, k % 3)).alias("links"))
    cited = F.struct(F.lit("pubmed_pubmed_refs").alias("linkname"), F.array(link(k + 3, k)).alias("links"))
    own = F.struct(F.array(F.when(k % 4 != 0, F.col("pmid")).otherwise("none")).alias("ids"), F.array(near, cited).alias("linksetdbs"))
    payloads = X.documents(spark, d).select("pmid", F.to_json(F.struct(F.array(own).alias("linksets"))).alias("payload"))
    return R.enrichment_links(payloads)


def s20_citation_edges(spark, d):
    k = F.col("doc_id")
    item = lambda x: F.struct(x.alias("id"))
    payload = F.when(k % 2 == 0, F.to_json(F.struct(F.array(item(k), item(k + 1)).alias("references"), F.array(item(k + 2)).alias("citations")))).otherwise(F.to_json(F.struct(F.struct(F.array(item(k)).alias("reference")).alias("message"))))
    payloads = X.documents(spark, d).select("pmid", F.lit("s").alias("service"), F.when(k % 9 == 0, "{bad").otherwise(payload).alias("payload"))
    return R.citation_edges(payloads)


def s20_open_access(spark, d):
    k = F.col("doc_id")
    best = F.struct(F.concat(F.lit("https://x.example/"), "doc_id").alias("url_for_pdf"), F.lit("cc-by").alias("license"))
    payload = F.to_json(F.struct((k % 2 == 0).alias("is_oa"), F.lit("gold").alias("oa_status"), F.when(k % 3 == 0, best).alias("best_oa_location")))
    payloads = X.documents(spark, d).select(F.when(k % 5 != 0, F.concat(F.lit("10.1/"), "doc_id")).alias("doi"), F.when(k % 7 == 0, "{bad").otherwise(payload).alias("payload"))
    return R.open_access(payloads)


def s20_preprints(spark, d):
    k = F.col("doc_id")
    docs = X.documents(spark, d).select("doc_id", F.explode(F.array(F.lit("medrxiv"), F.lit("biorxiv"))).alias("server"))
    versions = F.transform(F.sequence(F.lit(1), (k % 3 + 1).cast("int")), lambda v: F.struct(v.cast("string").alias("version")))
    doi = F.concat(F.when(k % 4 == 0, "10.5/").otherwise("10.1101/"), "doc_id")
    payloads = docs.where((F.col("server") == "medrxiv") | (k % 2 == 0)).select(doi.alias("doi"), "server", F.to_json(F.struct(versions.alias("collection"))).alias("payload"))
    return R.preprints(payloads)


def u04_merge_payload_batches(spark, d):
    docs = X.documents(spark, d).groupBy(F.floor(F.col("doc_id") / 100).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("doc_id", F.col("pmid").alias("id")))).alias("x"))
    listed = F.transform("x", lambda x: F.struct(x["id"].alias("id")))
    payload = F.when(F.col("batch") % 2 == 0, F.to_json(F.struct(listed.alias("documents")))).otherwise(F.to_json(F.struct(listed.alias("PubTator3"))))
    return R.merge_payload_batches(docs.select("batch", payload.alias("payload")))


# ---------------------------------------------------------------- sinks
def k04_gold_rows(spark, d):
    path = _folder(spark)
    gold = X.gold_with_text(spark, d).withColumn("annotation_id", F.concat("document_id", F.lit(":gold:"), "ordinal"))
    W.write_jsonl(W.gold_rows(gold), path, compression="gzip")
    schema = "document_id string, annotation_id string, span_text string, start int, end int, entity_type string, normalized_ids array<string>"
    return spark.read.schema(schema).json(path).withColumn("normalized_ids", F.array_join("normalized_ids", "|"))


def k06_status_table(spark, d):
    path = _folder(spark)
    W.write_tsv(K.annotator_statuses(X.annotations(spark, d, columns=["document_id", "source"]), X.documents(spark, d), X.ANNOTATORS), path)
    return spark.read.option("sep", "\t").option("header", True).schema("document_id string, name string, status string, annotation_count long, reason string").csv(path)


def k08_id_list(spark, d):
    path = _folder(spark)
    W.write_id_list(X.documents(spark, d), path)
    return spark.read.text(path).select(F.col("value").alias("pmid"))


def k09_results(spark, d):
    """Every line of the nested results, read back: its counts, and its text as a hash."""
    path = _folder(spark)
    n = X.partitions(spark, d)
    docs, annotations = X.documents(spark, d).select("document_id", "pmid", "title", "source").repartition(n, "document_id"), X.annotations(spark, d, dealt=n)
    keywords = K.keywords_table(K.keyword_summaries(annotations, dealt=True), docs).drop("pmid", "title")
    statuses = K.annotator_statuses(annotations, docs, X.ANNOTATORS)
    shown = annotations.select("document_id", "source_rank", "ordinal", "annotation_id", "source", "span_text", "start", "end", "entity_type", "canonical_id", F.round("confidence", 6).alias("confidence"))
    lines = W.results_lines(docs.select("document_id", "pmid", "title", "source"), shown, keywords, statuses, line_chars=4096)
    W.write_results_lines(lines, K.ingestion_summary(docs), path, compression="gzip")
    found = W.read_results_lines(spark, path).select("document_id", "part", F.size("annotations").alias("n_annotations"), F.size("keywords").alias("n_keywords"))
    value = spark.read.text(f"{path}/lines").select(F.get_json_object("value", "$.document_id").alias("document_id"), F.get_json_object("value", "$.part").cast("int").alias("part"), F.md5("value").alias("line_md5"))
    manifest = spark.read.text(f"{path}/manifest").select(F.lit("").alias("document_id"), F.lit(-1).alias("part"), F.get_json_object("value", "$.annotation_count").cast("int").alias("n_annotations"), F.get_json_object("value", "$.keyword_count").cast("int").alias("n_keywords"), F.md5("value").alias("line_md5"))
    return found.join(value, ["document_id", "part"]).unionByName(manifest)


_ALL = (
    s01_text_table, s02_corpus_json, s03_id_list, s04_raw_text_lines, s05_corpus_rows, s06_iob_rows, s16_pubmed_records, s18_full_text, s19_enrichment_links, s20_citation_edges, s20_open_access, s20_preprints,
    u04_merge_payload_batches, k04_gold_rows, k06_status_table, k08_id_list, k09_results,
)
QUERIES = {f.__name__: f for f in _ALL}

_D = "WITH " + X.SQL_DOCUMENTS
_A = "WITH " + X.SQL_PREDICTIONS
_KEPT = r"replace(regexp_replace({0}, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), chr(13), ' ')"

ORACLE_SQL = {
    "s01_text_table": _D + f" SELECT document_id, CAST(length(trim(title, {_BLANKS})) AS INTEGER) AS title_chars, md5(trim(abstract, {_BLANKS})) AS abstract_md5, 'text_table' AS source, coalesce(lang, '') AS lang FROM docs",
    "s02_corpus_json": _D + f""", n AS (SELECT *, row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id) - 1 AS i FROM docs)
SELECT CASE WHEN doc_id % 5 <> 0 THEN document_id WHEN doc_id % 7 <> 0 THEN 'PMID:' || pmid ELSE 'CORPUS:' || i END AS document_id, CASE WHEN doc_id % 7 <> 0 THEN pmid END AS pmid,
  CAST(length(trim(title, {_BLANKS})) AS INTEGER) AS title_chars, CASE WHEN doc_id % 3 = 0 THEN 'corpus' ELSE 'corpus b' END AS source FROM n""",
    "s03_id_list": _IDS + " SELECT pmid, count(*) AS n FROM ids WHERE pmid IS NOT NULL GROUP BY pmid",
    "s04_raw_text_lines": _D + f""", l AS (SELECT doc_id, trim(translate(text, chr(10) || chr(13), '  '), {_BLANKS}) AS line FROM docs)
SELECT 'text-' || row_number() OVER (ORDER BY doc_id) AS document_id, md5(line) AS abstract_md5 FROM l WHERE line <> ''""",
    "s05_corpus_rows": "WITH " + X.SQL_GOLD + """, k AS (SELECT doc_id, CASE WHEN entity_type = 'gene' THEN 'Chemical' ELSE 'Disease' END AS kind, ordinal, span_text, start_, end_, ids FROM goldt),
r AS (SELECT doc_id, count(*) FILTER (WHERE next_kind <> kind) AS n FROM (SELECT *, lead(kind) OVER (PARTITION BY doc_id ORDER BY ordinal) AS next_kind FROM k) GROUP BY doc_id)
SELECT docs.document_id, 2 AS passages, md5('[[' || CAST(to_json(title) AS VARCHAR) || '],[' || CAST(to_json(abstract) AS VARCHAR) || ']]') AS passages_md5, CAST(coalesce(r.n, 0) AS INTEGER) AS relations, 'T' || ordinal AS id, kind AS type, span_text AS text, start_ AS start, end_ AS "end", array_to_string(ids, '|') AS ids
FROM docs LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "s06_iob_rows": "WITH " + X.SQL_SPANS + " SELECT document_id AS id, CAST(count(*) AS INTEGER) AS tokens, CAST(sum(CASE h % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END) AS INTEGER) AS tags FROM sp GROUP BY ALL",
    "s16_pubmed_records": _D + f""", x AS (SELECT doc_id, trim({_KEPT.format("title")}, {_BLANKS}) AS t, trim({_KEPT.format("abstract")}, {_BLANKS}) AS a FROM docs)
SELECT CAST(doc_id AS VARCHAR) AS pmid, 'PMC' || doc_id AS pmcid, '10.1/' || doc_id AS doi, 'S' || doc_id AS pii, CAST(doc_id AS VARCHAR) AS issn, 'Print' AS issn_type, CAST(doc_id % 8 AS VARCHAR) AS nlm_unique_id, '2020' AS year,
  'J & K' AS journal, 'JK' AS journal_abbrev, CAST(doc_id % 9 AS VARCHAR) AS volume, CAST(doc_id % 4 AS VARCHAR) AS issue, '1-2' AS pages, 'UK' AS country, '2020-03-01' AS pub_date, '2019-02-01' AS epub_date, '2018-01-01' AS received_date,
  '2018-12-01' AS accepted_date, '2019-04-01' AS medline_date, '2019-05-01' AS entrez_date, '2021-11-30' AS revision_date, 'MEDLINE' AS citation_status, 'NLM' AS owner, '2' AS version,
  '[' || CASE WHEN a = '' THEN '' ELSE '{{"label":"AIM","nlm_category":"OBJECTIVE","text":"' || md5(a) || '"}},' END || '{{"label":"","nlm_category":"","text":"' || md5('Second x part') || '"}}]' AS structured_abstract,
  '["eng","ger"]' AS language, '["Review"]' AS publication_type, CASE WHEN doc_id % 5 = doc_id % 2 THEN '["U' || doc_id % 5 || '"]' ELSE '["U' || doc_id % 5 || '","U' || doc_id % 2 || '"]' END AS affiliations,
  '["k <1>","w' || doc_id % 4 || '"]' AS keywords, '["g' || doc_id % 6 || '"]' AS gene_symbols,
  '[{{"last":"L' || doc_id || '","first":"F","initials":"I","orcid":"0-' || doc_id % 7 || '","collective_name":"","affiliations":["U' || doc_id % 5 || '"]}},{{"last":"","first":"","initials":"","orcid":"","collective_name":"G","affiliations":["U' || doc_id % 2 || '"]}}]' AS authors,
  '[{{"descriptor":"M' || doc_id % 3 || '","descriptor_ui":"D1","major_topic":true,"qualifiers":[{{"name":"q","ui":"Q1","major_topic":false}}]}}]' AS mesh_terms, '[{{"registry_number":"0","name":"W' || doc_id % 3 || '","ui":"C1"}}]' AS chemicals,
  '[{{"name":"S","type":"Disease","ui":"S1"}}]' AS supplemental_mesh, '[{{"grant_id":"G' || doc_id || '","acronym":"","agency":"A","country":"C"}}]' AS grants, '[{{"ref_type":"Cites","ref_source":"s","pmid":"' || doc_id % 50 || '"}}]' AS comments_corrections,
  '[{{"name":"GEO","accession_numbers":["' || doc_id || '"]}}]' AS data_banks, md5(CASE WHEN a = '' THEN '' ELSE 'AIM: ' || a || ' ' END || 'Second x part') AS abstract_md5, CAST(length(t) AS INTEGER) AS title_chars FROM x""",
    "s18_full_text": _D + f""", x AS (SELECT doc_id, unnest(list_prepend(title, string_split(abstract, chr(10)))) AS b, generate_subscripts(list_prepend(title, string_split(abstract, chr(10))), 1) AS pos FROM docs),
y AS (SELECT doc_id, trim(regexp_replace({_KEPT.format("b")}, '[ \\t\\n]+', ' ', 'g')) AS b, min(pos) AS pos FROM x GROUP BY ALL),
t AS (SELECT doc_id, string_agg(b, chr(10) || chr(10) ORDER BY pos) FILTER (WHERE b <> '') AS t FROM y GROUP BY ALL)
SELECT document_id, CASE WHEN doc_id % 7 <> 0 THEN 'PMC' || doc_id END AS pmcid,
  CASE WHEN doc_id % 7 = 0 AND doc_id % 2 = 0 THEN 'not_in_pubmed_central' WHEN doc_id % 7 = 0 THEN 'no_pmcid_in_record' WHEN doc_id % 5 = 0 OR doc_id % 11 = 0 THEN 'failed' WHEN t IS NULL THEN 'empty_after_parse' ELSE 'ok' END AS full_text_status,
  CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 AND doc_id % 11 <> 0 THEN md5(t) END AS full_text_md5 FROM docs LEFT JOIN t USING (doc_id)""",
    "s19_enrichment_links": _D + """ SELECT pmid, kind, CAST(doc_id + plus AS VARCHAR) AS other, CAST(CASE plus WHEN 1 THEN doc_id % 10 WHEN 2 THEN doc_id % 3 END AS INTEGER) AS score
FROM docs, (VALUES ('related', 1), ('related', 2), ('references', 3)) AS v(kind, plus) WHERE doc_id % 4 <> 0""",
    "s20_citation_edges": _D + """ SELECT pmid, 's' AS service, direction, '{"id":' || (doc_id + plus) || '}' AS target FROM docs, (VALUES ('references', 0), ('references', 1), ('citations', 2)) AS v(direction, plus)
WHERE doc_id % 9 <> 0 AND (doc_id % 2 = 0 OR plus = 0)""",
    "s20_open_access": _D + """ SELECT '10.1/' || doc_id AS doi, doc_id % 2 = 0 AS is_oa, 'gold' AS status, CASE WHEN doc_id % 3 = 0 THEN 'https://x.example/' || doc_id END AS pdf_url, CASE WHEN doc_id % 3 = 0 THEN 'cc-by' END AS license
FROM docs WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0""",
    "s20_preprints": _D + """ SELECT '10.1101/' || doc_id AS doi, CASE WHEN doc_id % 2 = 0 THEN 'biorxiv' ELSE 'medrxiv' END AS server, '{"version":"' || (doc_id % 3 + 1) || '"}' AS record FROM docs WHERE doc_id % 4 <> 0""",
    "u04_merge_payload_batches": _D + """ SELECT CAST(doc_id // 100 AS BIGINT) AS batch, CAST(row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS INTEGER) AS position, '{"id":"' || pmid || '"}' AS document FROM docs""",
    "k04_gold_rows": "WITH " + X.SQL_GOLD + ' SELECT document_id, document_id || \':gold:\' || ordinal AS annotation_id, span_text, start_ AS start, end_ AS "end", entity_type, array_to_string(ids, \'|\') AS normalized_ids FROM goldt',
    "k06_status_table": _A + """, c AS (SELECT document_id, source AS name, count(*) AS n FROM ann GROUP BY ALL)
SELECT docs.document_id, s.name, CASE WHEN n > 0 THEN 'produced_annotations' ELSE 'no_annotations' END AS status, coalesce(n, 0) AS annotation_count, CASE WHEN n IS NULL THEN 'No annotations returned.' END AS reason
FROM docs CROSS JOIN (SELECT unnest(['a1', 'a2', 'a3', 'a4', 'a5']) AS name) s LEFT JOIN c ON c.document_id = docs.document_id AND c.name = s.name""",
    "k08_id_list": _D + " SELECT pmid FROM docs",
    "k09_results": _A + """, kw AS (""" + _KEYWORDS + """), anns AS (SELECT document_id, start_ // 4096 AS part, count(*) AS n, string_agg('{"annotation_id":"' || annotation_id || '","source":"' || source || '","span_text":' || CAST(to_json(span_text) AS VARCHAR) || ',"start":' || start_ || ',"end":' || end_
  || ',"entity_type":"' || entity_type || '","canonical_id":' || coalesce('"' || canonical_id || '"', 'null') || ',"confidence":' || coalesce(CAST(round(confidence, 6) AS VARCHAR), 'null') || '}', ',' ORDER BY source_rank, ordinal, annotation_id) AS x FROM ann GROUP BY ALL),
keys AS (SELECT document_id, start // 4096 AS part, count(*) AS n, string_agg('{"keyword":' || CAST(to_json(keyword) AS VARCHAR) || ',"start":' || start || ',"end":' || "end" || ',"annotation_count":' || annotation_count || ',"annotator_count":' || annotator_count
  || ',"labels":"' || labels || '","canonical_ids":"' || canonical_ids || '","sources":"' || sources || '"}', ',' ORDER BY start, "end", keyword) AS x FROM kw GROUP BY ALL),
cnt AS (SELECT document_id, source AS name, count(*) AS n FROM ann GROUP BY ALL),
sts AS (SELECT docs.document_id, s.name, coalesce(cnt.n, 0) AS n FROM docs CROSS JOIN (SELECT unnest(['a1', 'a2', 'a3', 'a4', 'a5']) AS name) s LEFT JOIN cnt ON cnt.document_id = docs.document_id AND cnt.name = s.name),
stats AS (SELECT document_id, string_agg('{"name":"' || name || '","status":"' || CASE WHEN n > 0 THEN 'produced_annotations' ELSE 'no_annotations' END || '","annotation_count":' || n || ',"reason":' || CASE WHEN n > 0 THEN 'null' ELSE '"No annotations returned."' END || '}', ',' ORDER BY name) AS x FROM sts GROUP BY ALL),
place AS (SELECT document_id, part FROM anns UNION SELECT document_id, part FROM keys UNION SELECT document_id, 0 FROM docs),
lines AS (SELECT p.document_id, p.part, coalesce(a.n, 0) AS na, coalesce(k.n, 0) AS nk, '{"document_id":"' || p.document_id || '","part":' || p.part || ',"document":' || CASE WHEN p.part = 0 THEN '{"pmid":"' || pmid || '","title":' || CAST(to_json(title) AS VARCHAR) || ',"source":' || coalesce(CAST(to_json(docs.source) AS VARCHAR), 'null') || '}' ELSE 'null' END
  || ',"annotators":[' || CASE WHEN p.part = 0 THEN stats.x ELSE '' END || '],"annotations":[' || coalesce(a.x, '') || '],"keywords":[' || coalesce(k.x, '') || ']}' AS line
  FROM place p JOIN docs USING (document_id) JOIN stats USING (document_id) LEFT JOIN anns a ON a.document_id = p.document_id AND a.part = p.part LEFT JOIN keys k ON k.document_id = p.document_id AND k.part = p.part)
SELECT document_id, CAST(part AS INTEGER) AS part, CAST(na AS INTEGER) AS n_annotations, CAST(nk AS INTEGER) AS n_keywords, md5(line) AS line_md5 FROM lines
UNION ALL SELECT '', -1, CAST(sum(na) AS INTEGER), CAST(sum(nk) AS INTEGER), md5('{"document_count":' || (SELECT count(*) FROM docs) || ',"line_count":' || count(*) || ',"annotation_count":' || CAST(sum(na) AS BIGINT) || ',"keyword_count":' || CAST(sum(nk) AS BIGINT)
  || ',"run_document_count":' || (SELECT count(*) FROM docs) || ',"run_with_pmid":' || (SELECT count(*) FROM docs WHERE pmid <> '') || ',"run_with_pmcid":0}') FROM lines""",
}
