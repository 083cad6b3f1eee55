"""Document payloads, gold corpora and publication records."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slice_text, strip
from .json_ranges import split_payloads
from .payloads import _ARRAY, get

#: Section labels of BioC passages.
TITLE_SECTIONS, ABSTRACT_SECTIONS = ("TITLE", "title", "Title", "front"), ("ABSTRACT", "abstract", "Abstract")
#: Entity types of the gold corpus that count as diseases.
DISEASE_TYPES = ("disease", "diseases", "specificdisease", "diseaseclass", "modifier", "compositediseasemention", "compositemention")


def merge_payload_batches(payloads: DataFrame, batch_col: str = "batch") -> DataFrame:
    """payloads(batch, payload): the documents of all batches as one list: batch, position, document (JSON).

    Payloads too large to parse come in pieces; what cannot be parsed at all is found by ``unparsable``."""
    v = F.try_parse_json("payload")
    lists = F.posexplode(F.coalesce(get(v, "$.documents", _ARRAY), get(v, "$.PubTator3", _ARRAY))).alias("position", "d")
    docs = split_payloads(payloads.select(batch_col, "payload")).select(batch_col, "piece_start", lists)
    return docs.select(batch_col, (F.col("position") + F.col("piece_start")).cast("int").alias("position"), F.to_json("d").alias("document"))


def bioc_to_documents(payloads: DataFrame, full_text: bool = True) -> DataFrame:
    """payloads(payload) -> documents: pmid, title, abstract and body from the labelled passages; without
    labels the first passage is the title and the others the abstract.  Documents without pmid are dropped."""
    v = F.try_parse_json("payload")
    docs = split_payloads(payloads.select("payload")).select(F.explode(F.coalesce(get(v, "$.documents", _ARRAY), get(v, "$.PubTator3", _ARRAY))).alias("d"))
    docs = docs.withColumn("ps", F.coalesce(get("d", "$.passages", _ARRAY), F.array().cast(_ARRAY)))
    infons = F.concat(F.array(get("d", "$.infons", "variant")), F.transform("ps", lambda p: get(p, "$.infons", "variant")))
    clean = lambda x: F.nullif(strip(x), F.lit(""))
    found = lambda *keys: F.get(F.filter(F.transform(infons, lambda i: F.coalesce(*(F.nullif(F.try_variant_get(i, f'$["{k}"]', "string"), F.lit("")) for k in keys))), lambda x: x.isNotNull()), F.lit(0))
    pmid = clean(F.coalesce(found("article-id_pmid", "pmid"), get("d", "$.id")))
    section = lambda p: F.coalesce(*(F.nullif(get(p, f"$.infons.{k}"), F.lit("")) for k in ("section_type", "type", "section")), F.lit(""))
    parts = F.filter(F.transform("ps", lambda p: F.named_struct(F.lit("s"), section(p), F.lit("t"), strip(F.coalesce(get(p, "$.text"), F.lit(""))))), lambda x: x["t"] != "")
    docs = docs.select(pmid.alias("pmid"), clean(found("article-id_pmc", "pmcid")).alias("pmcid"), parts.alias("x")).where("pmid IS NOT NULL")
    texts = lambda keep: F.transform(F.filter("x", keep), lambda y: y["t"])
    docs = docs.select("pmid", "pmcid", texts(lambda y: y["s"].isin(*TITLE_SECTIONS)).alias("t"), texts(lambda y: y["s"].isin(*ABSTRACT_SECTIONS)).alias("a"), texts(lambda y: (y["s"] != "") & ~y["s"].isin(*TITLE_SECTIONS, *ABSTRACT_SECTIONS)).alias("b"), texts(lambda y: y["s"] == "").alias("u"))
    lift = (F.size("t") == 0) & (F.size("u") > 0)
    docs = docs.withColumns({"t": F.when(lift, F.slice("u", 1, 1)).otherwise(F.col("t")), "u": F.when(lift, F.slice("u", 2, 1 << 30)).otherwise(F.col("u"))})
    move = F.size("a") == 0
    docs = docs.withColumns({"a": F.when(move, F.col("u")).otherwise(F.col("a")), "b": F.when(move, F.col("b")).otherwise(F.concat("u", "b"))})
    body = F.nullif(F.array_join("b", "\n\n"), F.lit("")) if full_text else F.lit(None).cast("string")
    return docs.select(F.concat(F.lit("PMID:"), "pmid").alias("document_id"), "pmid", "pmcid", F.array_join("t", " ").alias("title"), F.array_join("a", " ").alias("abstract"), body.alias("full_text"), F.lit("pubtator3").alias("source"))


# ---------------------------------------------------------------- gold corpora
def _part_text(p: Column) -> Column:
    return strip(F.array_join(F.filter(F.coalesce(p["text"], F.array().cast("array<string>")), lambda x: x.isNotNull()), " "))


def gold_documents(rows: DataFrame) -> DataFrame:
    """Corpus rows -> rows + title, abstract, text and shifts (source offset, what to add).

    A passage goes behind the parts of its kind seen so far; what is no title is placed after the titles
    seen so far.  One fold over the passages of a row, no shuffle."""
    state = "struct<t:string,a:string,shifts:array<struct<at:int,by:int>>>"
    start = F.from_json(F.lit('{"t":"","a":"","shifts":[]}'), state)

    def step(acc, p):
        title = F.lower(F.coalesce(p["type"], F.lit(""))).contains("title")
        text = _part_text(p)
        own = F.when(title, acc["t"]).otherwise(acc["a"])
        begin = F.length(own) + F.when(own != "", 1).otherwise(0) + F.when(~title & (acc["t"] != ""), F.length(acc["t"]) + 2).otherwise(0)
        joined = F.when(own != "", F.concat(own, F.lit(" "), text)).otherwise(text)
        offset = F.get(F.get(p["offsets"], F.lit(0)), F.lit(0))
        shifts = F.when(offset.isNotNull(), F.concat(F.filter(acc["shifts"], lambda s: s["at"] != offset), F.array(F.named_struct(F.lit("at"), offset, F.lit("by"), begin - offset)))).otherwise(acc["shifts"])
        return F.named_struct(F.lit("t"), F.when(title, joined).otherwise(acc["t"]), F.lit("a"), F.when(title, acc["a"]).otherwise(joined), F.lit("shifts"), shifts)

    folded = F.aggregate(F.coalesce("passages", F.filter("passages", lambda _: F.lit(False))), start, step)
    from ..functions.text import document_text

    return rows.withColumn("_f", folded).withColumns({"title": F.col("_f.t"), "abstract": F.col("_f.a"), "shifts": F.col("_f.shifts")}).withColumn("text", document_text("title", "abstract")).drop("_f")


def bigbio_gold(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corpus rows -> gold spans and warnings.

    Offsets move with the passage of largest offset at or before them; entities of other types and entities
    without offsets are skipped with a warning; a text that differs is only warned about."""
    e = gold_documents(rows).select("document_id", "text", "shifts", F.posexplode("entities").alias("index", "e"))
    offsets = F.get("e.offsets", F.lit(0))
    e = e.withColumns({"raw_type": strip(F.coalesce("e.type", F.lit(""))), "s0": F.get(offsets, F.lit(0)), "e0": F.get(offsets, F.lit(1)), "span": _part_text(F.col("e"))})
    e = e.withColumn("kind", F.when(F.lower("raw_type").isin(*DISEASE_TYPES), "disease").otherwise(F.lower("raw_type")))
    near = F.filter("shifts", lambda s: s["at"] <= F.col("s0"))
    shift = F.coalesce(F.array_max(near)["by"], F.lit(0))  # structs compare by their first field
    e = e.withColumns({"start": F.col("s0") + shift, "end": F.col("e0") + shift}).withColumn("observed", slice_text("text", "start", "end"))
    usable = F.col("s0").isNotNull() & F.col("e0").isNotNull()
    ids = F.filter(F.transform(F.coalesce("e.normalized", F.filter("e.normalized", lambda _: F.lit(False))), lambda n: F.when(F.coalesce(strip(n["db_name"]), F.lit("")) == "", strip(n["db_id"])).when(strip(n["db_id"]) != "", F.concat(strip(n["db_name"]), F.lit(":"), strip(n["db_id"])))), lambda x: x.isNotNull() & (x != ""))
    gold = e.where((F.col("kind") == "disease") & usable).select("document_id", F.col("index").alias("ordinal"), F.coalesce(F.nullif("e.id", F.lit("")), F.concat("document_id", F.lit(":gold:"), "index")).alias("annotation_id"), F.coalesce(F.nullif("span", F.lit("")), "observed").alias("span_text"), "start", "end", F.col("kind").alias("entity_type"), F.nullif("raw_type", F.lit("")).alias("raw_entity_type"), F.coalesce(ids, F.array().cast("array<string>")).alias("normalized_ids"))
    warning = F.when(F.col("kind") != "disease", "unsupported_type").when(~usable, "no_offsets").when((F.col("span") != "") & (F.col("span") != F.col("observed")), "text_mismatch")
    return gold, e.select("document_id", "index", warning.alias("warning"), F.col("raw_type"), "start", "end").where("warning IS NOT NULL")


# ---------------------------------------------------------------- literature services
def epmc_to_documents(payloads: DataFrame) -> DataFrame:
    """payloads(payload): search results -> documents with flags and links."""
    r = payloads.select(F.explode(get(F.try_parse_json("payload"), "$.resultList.result", _ARRAY)).alias("r"))
    text = lambda k: strip(F.coalesce(get("r", f"$.{k}"), F.lit("")))
    flag = lambda k: F.when(F.upper(text(k)).isin("Y", "YES", "TRUE", "1"), True).when(F.upper(text(k)).isin("N", "NO", "FALSE", "0"), False)
    r = r.withColumns({"pmid": text("pmid"), "pmcid": text("pmcid"), "id": text("id"), "src": text("source")})
    document_id = F.when(F.col("pmid") != "", F.concat(F.lit("PMID:"), "pmid")).when(F.col("pmcid").startswith("PMC"), F.col("pmcid")).when(F.col("pmcid") != "", F.concat(F.lit("PMC"), "pmcid")).when(F.col("id") != "", F.concat(F.coalesce(F.nullif("src", F.lit("")), F.lit("EPMC")), F.lit(":"), "id")).otherwise("EPMC:UNKNOWN")
    cited = F.when(F.schema_of_variant(F.coalesce(get("r", "$.citedByCount", "variant"), F.parse_json(F.lit("null")))) == "BIGINT", get("r", "$.citedByCount", "long"))
    urls = F.transform(get("r", "$.fullTextUrlList.fullTextUrl", _ARRAY), lambda u: F.named_struct(F.lit("url"), strip(F.coalesce(get(u, "$.url"), F.lit(""))), F.lit("site"), strip(F.coalesce(get(u, "$.site"), F.lit(""))), F.lit("availability"), strip(F.coalesce(get(u, "$.availability"), F.lit(""))), F.lit("document_style"), strip(F.coalesce(get(u, "$.documentStyle"), F.lit("")))))
    return r.select(document_id.alias("document_id"), F.nullif("pmid", F.lit("")).alias("pmid"), F.nullif("pmcid", F.lit("")).alias("pmcid"), text("title").alias("title"), text("abstractText").alias("abstract"), F.nullif(text("pubYear"), F.lit("")).alias("year"), F.lit("europe_pmc").alias("source"),
                    F.nullif(text("doi"), F.lit("")).alias("doi"), cited.alias("citation_count"), flag("isOpenAccess").alias("is_open_access"), flag("inEPMC").alias("in_epmc"), flag("inPMC").alias("in_pmc"), F.nullif(text("license"), F.lit("")).alias("license"), urls.alias("full_text_urls"))


def jats_to_plain(xml: str | None) -> str:
    """Titles and paragraphs of the body, inline parts joined by a blank, white space collapsed, equal blocks
    once; '' if there is none."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return ""
    local = lambda tag: tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""
    body = next((n for n in root.iter() if local(n.tag) == "body"), None)
    blocks = [] if body is None else [" ".join(" ".join(n.itertext()).split()) for n in body.iter() if local(n.tag) in ("title", "p")]
    return "\n\n".join(dict.fromkeys(b for b in blocks if b))


def attach_full_text(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """documents(pmcid, in_pmc, ...) + full_text and full_text_status from texts(pmcid, xml)."""

    def plain(batches):
        for batch in batches:
            xml = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({"pmcid": batch.column(0), "plain": pa.array([jats_to_plain(x) for x in xml], pa.string()), "failed": pa.array([x is None for x in xml])})

    parsed = texts.select("pmcid", "xml").mapInArrow(plain, "pmcid string, plain string, failed boolean")
    df = documents.join(parsed, "pmcid", "left")
    no_id = F.coalesce("pmcid", F.lit("")) == ""
    status = F.when(no_id & (F.col("in_pmc") == F.lit(False)), "not_in_pubmed_central").when(no_id, "no_pmcid_in_record").when(F.coalesce("failed", F.lit(True)), "failed").when(F.col("plain") == "", "empty_after_parse").otherwise("ok")
    return df.withColumn("full_text_status", status).withColumn("full_text", F.nullif("plain", F.lit(""))).drop("plain", "failed")


def enrichment_links(payloads: DataFrame) -> DataFrame:
    """payloads(pmid, payload): link payloads -> pmid, kind, other, score; only link sets of the pmid itself."""
    df = payloads.select("pmid", F.explode(get(F.try_parse_json("payload"), "$.linksets", _ARRAY)).alias("s")).where(get("s", "$.ids[0]") == F.col("pmid"))
    df = df.select("pmid", F.explode(get("s", "$.linksetdbs", _ARRAY)).alias("d")).withColumn("name", get("d", "$.linkname"))
    kind = F.when(F.col("name") == "pubmed_pubmed", "related").when(F.col("name") == "pubmed_pubmed_citedin", "cited_by").when(F.col("name") == "pubmed_pubmed_refs", "references")
    df = df.select("pmid", kind.alias("kind"), F.explode(get("d", "$.links", _ARRAY)).alias("l")).where("kind IS NOT NULL")
    return df.select("pmid", "kind", F.coalesce(get("l", "$.id"), get("l", "$")).alias("other"), F.when(F.col("kind") == "related", F.coalesce(get("l", "$.score", "int"), F.lit(0))).alias("score"))


def citation_edges(payloads: DataFrame) -> DataFrame:
    """payloads(pmid, service, payload): reference and citation lists -> pmid, service, direction, target."""
    v = F.try_parse_json("payload")
    lists = {"references": ("references", "reference", "message.reference", "referenceList.reference", "data.references"), "citations": ("citations", "citation", "citationList.citation", "data.citations")}
    parts = [payloads.select("pmid", "service", F.lit(d).alias("direction"), F.explode(F.coalesce(*(get(v, f"$.{p}", _ARRAY) for p in paths))).alias("t")) for d, paths in lists.items()]
    return parts[0].unionByName(parts[1]).select("pmid", "service", "direction", F.to_json("t").alias("target"))


def open_access(payloads: DataFrame) -> DataFrame:
    """payloads(doi, payload) -> is_oa, status, pdf url and license of the best location."""
    v = F.try_parse_json("payload")
    return payloads.where(v.isNotNull() & F.col("doi").isNotNull()).select("doi", get(v, "$.is_oa", "boolean").alias("is_oa"), get(v, "$.oa_status").alias("status"), get(v, "$.best_oa_location.url_for_pdf").alias("pdf_url"), get(v, "$.best_oa_location.license").alias("license"))


def preprints(payloads: DataFrame, servers: tuple[str, ...] = ("biorxiv", "medrxiv")) -> DataFrame:
    """payloads(doi, server, payload) -> the last version of the first server that has one; only DOIs of the
    preprint prefix."""
    last = F.element_at(get(F.try_parse_json("payload"), "$.collection", _ARRAY), -1)
    rank = F.array_position(F.array(*map(F.lit, servers)), F.col("server"))
    df = payloads.where(F.col("doi").startswith("10.1101/")).select("doi", "server", rank.alias("r"), last.alias("v")).where("v IS NOT NULL AND r > 0")
    best = df.groupBy("doi").agg(F.min_by(F.struct("server", F.to_json("v").alias("record")), "r").alias("b"))
    return best.select("doi", "b.server", "b.record")
