"""A publication record by a plain XML tree: what the expressions must give."""

import xml.etree.ElementTree as ET


def pubmed_record(xml: str) -> dict | None:
    """One PubmedArticle as a record.  Element text is all text below it.  Article ids are those of the
    article itself: ids inside reference lists do not overwrite them."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    node = lambda path, of=root: None if of is None else of.find(path)
    every = lambda path, of=root: [] if of is None else of.findall(path)
    text = lambda n: "" if n is None else "".join(n.itertext()).strip()
    at = lambda path, of=root: text(node(path, of))
    texts = lambda path, of=root: [t for n in every(path, of) if (t := text(n))]
    yes = lambda n: n.get("MajorTopicYN", "N") == "Y"
    medline = node("MedlineCitation")
    article, info = node("Article", medline), node("MedlineJournalInfo", medline)
    issue, journal, data = node("Journal/JournalIssue", article), node("Journal", article), node("PubmedData")

    def date(n) -> str | None:
        year = at("Year", n) if n is not None else ""
        return f"{year}-{(at('Month', n) or '01').zfill(2)}-{(at('Day', n) or '01').zfill(2)}" if year else None

    published = node("PubDate", issue)
    medline_date = at("MedlineDate", published)
    history = {(n.get("PubStatus") or "").strip().lower(): date(n) for n in every("History/PubMedPubDate", data)}
    ids = {(n.get("IdType") or "").strip().lower(): t for n in every("ArticleIdList/ArticleId", data) if (t := text(n))}
    pmcid = ids.get("pmc")
    sections = [{"label": (n.get("Label") or "").strip(), "nlm_category": (n.get("NlmCategory") or "").strip(), "text": t} for n in every(".//AbstractText", article) if (t := text(n))]
    authors = [{"last": at("LastName", a), "first": at("ForeName", a), "initials": at("Initials", a), "collective_name": at("CollectiveName", a), "affiliations": texts("AffiliationInfo/Affiliation", a),
                "orcid": next((text(i).removeprefix("https://orcid.org/").strip() for i in every("Identifier", a) if (i.get("Source") or "").strip().upper() == "ORCID"), "")} for a in every("AuthorList/Author", article)]
    issn, pmid = node("ISSN", journal), node("PMID", medline)
    return {
        "pmid": text(pmid), "version": "" if pmid is None else (pmid.get("Version") or "").strip(), "pmcid": pmcid and (pmcid if pmcid.upper().startswith("PMC") else f"PMC{pmcid}"), "doi": ids.get("doi"), "pii": ids.get("pii"),
        "issn": text(issn) or at("ISSNLinking", info), "issn_type": "" if issn is None else issn.get("IssnType", ""), "nlm_unique_id": at("NlmUniqueID", info), "title": at("ArticleTitle", article),
        "abstract": " ".join(f"{s['label']}: {s['text']}" if s["label"] else s["text"] for s in sections), "structured_abstract": sections, "year": at("Year", published) or medline_date or None,
        "journal": at("Title", journal), "journal_abbrev": at("ISOAbbreviation", journal) or at("MedlineTA", info), "volume": at("Volume", issue), "issue": at("Issue", issue), "pages": at("Pagination/MedlinePgn", article), "country": at("Country", info),
        "pub_date": medline_date or date(published), "epub_date": next((date(n) for n in every("ArticleDate", article) if (n.get("DateType") or "").strip().lower() == "electronic"), None),
        "received_date": history.get("received"), "accepted_date": history.get("accepted"), "medline_date": history.get("medlinerec", history.get("medline")), "entrez_date": history.get("entrez"), "revision_date": date(node("DateRevised", medline)),
        "citation_status": "" if medline is None else medline.get("Status", ""), "owner": "" if medline is None else medline.get("Owner", ""), "language": texts("Language", article), "publication_type": texts("PublicationTypeList/PublicationType", article),
        "keywords": texts("KeywordList/Keyword", medline), "gene_symbols": texts("GeneSymbolList/GeneSymbol", medline), "authors": authors, "affiliations": list(dict.fromkeys(x for a in authors for x in a["affiliations"])),
        "mesh_terms": [{"descriptor": text(n), "descriptor_ui": n.get("UI", ""), "major_topic": yes(n), "qualifiers": [{"name": text(q), "ui": q.get("UI", ""), "major_topic": yes(q)} for q in every("QualifierName", h) if text(q)]} for h in every("MeshHeadingList/MeshHeading", medline) if (n := node("DescriptorName", h)) is not None],
        "chemicals": [{"registry_number": at("RegistryNumber", c), "name": at("NameOfSubstance", c), "ui": "" if (n := node("NameOfSubstance", c)) is None else n.get("UI", "")} for c in every("ChemicalList/Chemical", medline)],
        "supplemental_mesh": [{"name": text(n), "type": n.get("Type", ""), "ui": n.get("UI", "")} for n in every("SupplMeshList/SupplMeshName", medline)],
        "grants": [{"grant_id": at("GrantID", g), "acronym": at("Acronym", g), "agency": at("Agency", g), "country": at("Country", g)} for g in every("GrantList/Grant", article)],
        "comments_corrections": [{"ref_type": c.get("RefType", ""), "ref_source": at("RefSource", c), "pmid": at("PMID", c)} for c in every("CommentsCorrectionsList/CommentsCorrections", data)],
        "data_banks": [{"name": at("DataBankName", b), "accession_numbers": texts("AccessionNumber", b)} for b in every("DataBankList/DataBank", article)],
    }
