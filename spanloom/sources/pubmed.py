"""Publication records from XML, by Spark's text and XML readers and column expressions.

Files are read as text cut behind each article's end tag, so a large file is many tasks and no row is a file.
Inline markup (all elements but those that are read) is taken out of an article while its text is still
escaped; what is left has no mixed content and is parsed once, under one schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PUBMED_TEXT = ("pmid", "pmcid", "doi", "pii", "issn", "issn_type", "nlm_unique_id", "title", "abstract", "year", "journal", "journal_abbrev", "volume", "issue", "pages", "country", "pub_date", "epub_date", "received_date", "accepted_date", "medline_date", "entrez_date", "revision_date", "citation_status", "owner", "version")
PUBMED_RECORD = (", ".join(f"{c} string" for c in _PUBMED_TEXT) + ", structured_abstract array<struct<label:string,nlm_category:string,text:string>>, language array<string>, publication_type array<string>, affiliations array<string>, keywords array<string>, gene_symbols array<string>, "
    "authors array<struct<last:string,first:string,initials:string,orcid:string,collective_name:string,affiliations:array<string>>>, mesh_terms array<struct<descriptor:string,descriptor_ui:string,major_topic:boolean,qualifiers:array<struct<name:string,ui:string,major_topic:boolean>>>>, "
    "chemicals array<struct<registry_number:string,name:string,ui:string>>, supplemental_mesh array<struct<name:string,type:string,ui:string>>, grants array<struct<grant_id:string,acronym:string,agency:string,country:string>>, comments_corrections array<struct<ref_type:string,ref_source:string,pmid:string>>, data_banks array<struct<name:string,accession_numbers:array<string>>>")  # fmt: skip
PUBMED_FIELDS = [*_PUBMED_TEXT, "structured_abstract", "language", "publication_type", "affiliations", "keywords", "gene_symbols", "authors", "mesh_terms", "chemicals", "supplemental_mesh", "grants", "comments_corrections", "data_banks"]

_TEXT = "_VALUE:string"
_DATE = "struct<Year:string,Month:string,Day:string>"
_NAMED = f"struct<_UI:string,_MajorTopicYN:string,{_TEXT}>"
#: The elements that are read, as they nest.
_ARTICLE = (
    f"Journal:struct<ISSN:struct<_IssnType:string,{_TEXT}>,JournalIssue:struct<Volume:string,Issue:string,PubDate:struct<Year:string,Month:string,Day:string,MedlineDate:string>>,Title:string,ISOAbbreviation:string>,"
    f"ArticleTitle:struct<_book:string,{_TEXT}>,Pagination:struct<MedlinePgn:string>,Abstract:struct<AbstractText:array<struct<_Label:string,_NlmCategory:string,{_TEXT}>>>,"
    f"AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,Initials:string,CollectiveName:string,Identifier:array<struct<_Source:string,{_TEXT}>>,AffiliationInfo:array<struct<Affiliation:array<string>>>>>>,"
    f"Language:array<string>,PublicationTypeList:struct<PublicationType:array<struct<_UI:string,{_TEXT}>>>,GrantList:struct<Grant:array<struct<GrantID:string,Acronym:string,Agency:string,Country:string>>>,"
    "DataBankList:struct<DataBank:array<struct<DataBankName:string,AccessionNumber:array<string>>>>,ArticleDate:array<struct<_DateType:string,Year:string,Month:string,Day:string>>"
)
_MEDLINE = (
    f"_Status:string,_Owner:string,PMID:struct<_Version:string,{_TEXT}>,DateRevised:{_DATE},Article:struct<{_ARTICLE}>,MedlineJournalInfo:struct<Country:string,MedlineTA:string,NlmUniqueID:string,ISSNLinking:string>,"
    f"ChemicalList:struct<Chemical:array<struct<RegistryNumber:string,NameOfSubstance:struct<_UI:string,{_TEXT}>>>>,SupplMeshList:struct<SupplMeshName:array<struct<_Type:string,_UI:string,{_TEXT}>>>,"
    f"GeneSymbolList:struct<GeneSymbol:array<string>>,MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:{_NAMED},QualifierName:array<{_NAMED}>>>>,KeywordList:array<struct<Keyword:array<struct<_MajorTopicYN:string,{_TEXT}>>>>"
)
_DATA = (
    f"History:struct<PubMedPubDate:array<struct<_PubStatus:string,Year:string,Month:string,Day:string>>>,ArticleIdList:struct<ArticleId:array<struct<_IdType:string,{_TEXT}>>>,"
    f"CommentsCorrectionsList:struct<CommentsCorrections:array<struct<_RefType:string,RefSource:string,PMID:struct<_Version:string,{_TEXT}>>>>"
)
_SCHEMA = f"MedlineCitation struct<{_MEDLINE}>, PubmedData struct<{_DATA}>, _broken string"  # what cannot be parsed stands last
#: Elements that hold others of their own names in reference lists; their ids are not the article's.
_FOREIGN = r"(?s)<ReferenceList[ >].*</ReferenceList>"


def _names(schema: str) -> list[str]:
    """The element names of a schema text."""
    words = schema.replace("<", " ").replace(">", " ").replace(",", " ").replace("struct", " ").replace("array", " ").split()
    return sorted({w.split(":")[0] for w in words if w[0].isupper()} | {"PubmedArticle", "MedlineCitation", "PubmedData"})


#: Any tag but those of elements that are read, comments included.
INLINE = rf"(?s)<!--.*?-->|</?(?!(?:{'|'.join(_names(_MEDLINE + ',' + _DATA))})[\s/>])[A-Za-z][^<>]*>"


def _text(x: Column) -> Column:
    return F.coalesce(F.trim(x, F.lit(" \t\r\n")), F.lit(""))


def _date(d: Column) -> Column:
    pad = lambda x: F.when(_text(x) == "", "01").otherwise(F.when(F.length(_text(x)) < 2, F.concat(F.lit("0"), _text(x))).otherwise(_text(x)))
    return F.when(_text(d["Year"]) != "", F.concat_ws("-", _text(d["Year"]), pad(d["Month"]), pad(d["Day"])))


def _texts(x: Column) -> Column:
    """Trimmed texts of an array that may be null, blank ones left out."""
    return F.coalesce(F.filter(F.transform(x, _text), lambda v: v != ""), F.array().cast("array<string>"))


def _structs(x: Column, fields: dict, keep=None) -> Column:
    """An array of elements as an array of structs; null becomes empty."""
    made = F.transform(F.filter(x, keep) if keep else x, lambda e: F.struct(*(make(e).alias(name) for name, make in fields.items())))
    return F.coalesce(made, F.filter(F.array(F.struct(*(make(F.get(x, F.lit(0))).alias(name) for name, make in fields.items()))), lambda _: F.lit(False)))


def _last(entries: Column, attribute: str, *wanted: str, value=None) -> Column:
    """Of the entries whose attribute is the first of the wanted names that occurs, the last one's value."""
    of = lambda name: F.filter(entries, lambda e: F.lower(_text(e[attribute])) == name)
    found = [F.when(F.size(of(name)) > 0, F.struct(value(F.element_at(of(name), -1)).alias("v"))) for name in wanted]
    return F.coalesce(*found)["v"]


def pubmed_xml_to_records(articles: DataFrame, xml_col: str = "xml") -> DataFrame:
    """articles(xml), one PubmedArticle element each -> records; what cannot be parsed gives no row.  (Markup that is
    no part of a record is not checked.)

    Element text is all text below it.  Article ids are those of the article itself: ids inside reference lists do
    not overwrite them."""
    plain = F.regexp_replace(F.regexp_replace(xml_col, _FOREIGN, ""), INLINE, "")
    # tags taken out of a text leave it whole; the parser must keep blanks, which are trimmed below
    parsed = F.from_xml(plain, _SCHEMA, {"columnNameOfCorruptRecord": "_broken", "ignoreSurroundingSpaces": "false"})
    df = articles.where(F.col(xml_col).isNotNull()).select(parsed.alias("x")).where("x IS NOT NULL AND x._broken IS NULL").select("x.*")
    m, data = F.col("MedlineCitation"), F.col("PubmedData")
    article, info = m["Article"], m["MedlineJournalInfo"]
    journal, issue = article["Journal"], article["Journal"]["JournalIssue"]
    ids = F.filter(data["ArticleIdList"]["ArticleId"], lambda e: _text(e["_VALUE"]) != "")
    own_id = lambda kind: _last(ids, "_IdType", kind, value=lambda e: _text(e["_VALUE"]))
    history = lambda *status: _last(data["History"]["PubMedPubDate"], "_PubStatus", *status, value=_date)
    medline_date, published = F.nullif(_text(issue["PubDate"]["MedlineDate"]), F.lit("")), _date(issue["PubDate"])
    sections = _structs(article["Abstract"]["AbstractText"], {"label": lambda e: _text(e["_Label"]), "nlm_category": lambda e: _text(e["_NlmCategory"]), "text": lambda e: _text(e["_VALUE"])}, lambda e: _text(e["_VALUE"]) != "")
    said = F.transform(F.col("structured_abstract"), lambda s: F.when(s["label"] != "", F.concat(s["label"], F.lit(": "), s["text"])).otherwise(s["text"]))
    orcid = lambda a: F.get(F.filter(a["Identifier"], lambda i: F.upper(_text(i["_Source"])) == "ORCID"), F.lit(0))["_VALUE"]
    authors = _structs(article["AuthorList"]["Author"], {
        "last": lambda a: _text(a["LastName"]), "first": lambda a: _text(a["ForeName"]), "initials": lambda a: _text(a["Initials"]),
        "orcid": lambda a: F.trim(F.regexp_replace(_text(orcid(a)), "^https://orcid.org/", "")), "collective_name": lambda a: _text(a["CollectiveName"]),
        "affiliations": lambda a: _texts(F.flatten(F.transform(a["AffiliationInfo"], lambda i: F.coalesce(i["Affiliation"], F.array().cast("array<string>"))))),
    })
    yes = lambda e: F.coalesce(e["_MajorTopicYN"], F.lit("N")) == "Y"
    named = lambda e: _text(e["_VALUE"])
    mesh = _structs(m["MeshHeadingList"]["MeshHeading"], {
        "descriptor": lambda h: named(h["DescriptorName"]), "descriptor_ui": lambda h: F.coalesce(h["DescriptorName"]["_UI"], F.lit("")), "major_topic": lambda h: yes(h["DescriptorName"]),
        "qualifiers": lambda h: _structs(h["QualifierName"], {"name": named, "ui": lambda q: F.coalesce(q["_UI"], F.lit("")), "major_topic": yes}, lambda q: named(q) != ""),
    }, lambda h: h["DescriptorName"].isNotNull())
    values = {
        "pmid": _text(m["PMID"]["_VALUE"]), "pmcid": F.when(F.upper(own_id("pmc")).startswith("PMC"), own_id("pmc")).otherwise(F.concat(F.lit("PMC"), own_id("pmc"))), "doi": own_id("doi"), "pii": own_id("pii"),
        "issn": F.coalesce(F.nullif(_text(journal["ISSN"]["_VALUE"]), F.lit("")), _text(info["ISSNLinking"])), "issn_type": F.coalesce(journal["ISSN"]["_IssnType"], F.lit("")), "nlm_unique_id": _text(info["NlmUniqueID"]), "title": _text(article["ArticleTitle"]["_VALUE"]),
        "abstract": F.array_join(said, " "), "year": F.coalesce(F.nullif(_text(issue["PubDate"]["Year"]), F.lit("")), medline_date), "journal": _text(journal["Title"]),
        "journal_abbrev": F.coalesce(F.nullif(_text(journal["ISOAbbreviation"]), F.lit("")), _text(info["MedlineTA"])), "volume": _text(issue["Volume"]), "issue": _text(issue["Issue"]), "pages": _text(article["Pagination"]["MedlinePgn"]), "country": _text(info["Country"]),
        "pub_date": F.coalesce(medline_date, published), "epub_date": _date(F.get(F.filter(article["ArticleDate"], lambda d: F.lower(_text(d["_DateType"])) == "electronic"), F.lit(0))), "received_date": history("received"), "accepted_date": history("accepted"),
        "medline_date": history("medlinerec", "medline"), "entrez_date": history("entrez"), "revision_date": _date(m["DateRevised"]), "citation_status": F.coalesce(m["_Status"], F.lit("")), "owner": F.coalesce(m["_Owner"], F.lit("")), "version": _text(m["PMID"]["_Version"]),
        "structured_abstract": F.col("structured_abstract"), "language": _texts(article["Language"]), "publication_type": _texts(F.transform(article["PublicationTypeList"]["PublicationType"], named)),
        "affiliations": F.array_distinct(F.flatten(F.transform(F.col("authors"), lambda a: a["affiliations"]))), "keywords": _texts(F.transform(F.flatten(F.transform(m["KeywordList"], lambda k: F.coalesce(k["Keyword"], F.filter(k["Keyword"], lambda _: F.lit(False))))), named)),
        "gene_symbols": _texts(m["GeneSymbolList"]["GeneSymbol"]), "authors": F.col("authors"), "mesh_terms": mesh,
        "chemicals": _structs(m["ChemicalList"]["Chemical"], {"registry_number": lambda c: _text(c["RegistryNumber"]), "name": lambda c: named(c["NameOfSubstance"]), "ui": lambda c: F.coalesce(c["NameOfSubstance"]["_UI"], F.lit(""))}),
        "supplemental_mesh": _structs(m["SupplMeshList"]["SupplMeshName"], {"name": named, "type": lambda e: F.coalesce(e["_Type"], F.lit("")), "ui": lambda e: F.coalesce(e["_UI"], F.lit(""))}),
        "grants": _structs(article["GrantList"]["Grant"], {"grant_id": lambda g: _text(g["GrantID"]), "acronym": lambda g: _text(g["Acronym"]), "agency": lambda g: _text(g["Agency"]), "country": lambda g: _text(g["Country"])}),
        "comments_corrections": _structs(data["CommentsCorrectionsList"]["CommentsCorrections"], {"ref_type": lambda c: F.coalesce(c["_RefType"], F.lit("")), "ref_source": lambda c: _text(c["RefSource"]), "pmid": lambda c: named(c["PMID"])}),
        "data_banks": _structs(article["DataBankList"]["DataBank"], {"name": lambda b: _text(b["DataBankName"]), "accession_numbers": lambda b: _texts(b["AccessionNumber"])}),
    }
    df = df.withColumns({"structured_abstract": sections, "authors": authors})
    return df.select(*(values[n].alias(n) for n in PUBMED_FIELDS))


def read_pubmed_xml(spark: SparkSession, path: str) -> DataFrame:
    """xml: the PubmedArticle elements of XML files.  Spark cuts the files at the end tags, so a file is many tasks."""
    pieces = spark.read.text(path, lineSep="</PubmedArticle>")
    start = F.regexp_extract("value", r"(?s)^.*?(<PubmedArticle[ >].*)$", 1)
    return pieces.select(start.alias("xml")).where("xml <> ''").select(F.concat("xml", F.lit("</PubmedArticle>")).alias("xml"))


def split_articles(files: DataFrame, column: str = "value") -> DataFrame:
    """files(value) of whole XML files -> one row per PubmedArticle element."""
    return files.select(F.explode(F.regexp_extract_all(column, F.lit(r"(?s)<PubmedArticle[ >].*?</PubmedArticle>"), F.lit(0))).alias("xml"))
