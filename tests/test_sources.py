import json

import pytest

from spanloom.operators import harmonize, sinks
from spanloom.sources import files, payloads, pubmed, records

from . import plain_pubmed

DOC = "document_id string, text string, title string"


def spans(df):
    return [tuple(r) for r in harmonize.make_annotations(df, "text").orderBy("ordinal").select("span_text", "start", "end", "entity_type", "canonical_id", "canonical_name", "confidence").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("d", "Title here\n\nA gbm and p53 (the cat).", "Title here")], DOC)


def of(spark, payload):
    return spark.createDataFrame([("d", payload if isinstance(payload, str) or payload is None else json.dumps(payload))], "document_id string, payload string")


def test_bioc(spark, docs):
    passages = [{"offset": 100, "text": "Title here", "infons": {"type": "title"}}, {"offset": 900, "text": "not in the text", "infons": {"type": "abstract"}, "annotations": [{"text": "gbm", "infons": {"type": "Disease", "identifier": "MESH:D1", "name": "n"}, "locations": [{"offset": 902, "length": 3}]}, {"locations": [{"offset": 910, "length": 3}], "type": "Gene", "id": 7}, {"text": "", "locations": []}]}]
    want = [("gbm", 14, 17, "disease", "MESH:D1", "n", None), ("p53", 22, 25, "gene", "7", None, None)]
    for payload in ({"documents": [{"passages": passages}]}, {"PubTator3": [{"passages": passages}]}, {"passages": passages}, [{"passages": passages}]):
        assert spans(payloads.bioc_to_annotations(of(spark, payload), docs)) == want
    for payload in ("not ready yet", "", None, "{}"):
        assert spans(payloads.bioc_to_annotations(of(spark, payload), docs)) == []


def test_text_families(spark, docs):
    assert spans(payloads.pubannotation_to_annotations(of(spark, {"denotations": [{"span": {"begin": 14, "end": 17}, "obj": "Disease:MESH:D1"}, {"span": {"begin": 0, "end": 5}, "obj": "Gene"}]}), docs)) == [("gbm", 14, 17, "disease", "MESH:D1", None, None), ("Title", 0, 5, "gene", None, None, None)]
    lines = "1|t|x\n1\t14\t17\tgbm\tDisease\tMESH:D1\n\n1\tq\t17\tgbm\tDisease\tx\n1\t22\t25\tp53\tGene"
    assert spans(payloads.pubtator_text_to_annotations(of(spark, lines), docs)) == [("gbm", 14, 17, "disease", "MESH:D1", None, None)]
    assert len(spans(payloads.pubtator_text_to_annotations(of(spark, lines), docs, "aioner", 5))) == 2
    brat = "T1\tdisease 14 17\tgbm\nN1\tReference T1 KB:1\tname\nT2\tgene 22 23;24 25\tp53\nT1\tdisease 14 18\tgbm\nN9\tReference T9 x\ty"
    assert spans(payloads.brat_to_annotations(of(spark, brat), docs)) == [("gbm", 14, 18, "disease", "KB:1", "name", None), ("p53", 22, 25, "gene", None, None, None)]


def test_records(spark, docs):
    items = [{"entity_group": "problem", "start": 26, "end": 35, "word": "w", "score": 0.5}, {"entity_group": "O", "start": 14, "end": 17}, {"entity": "x", "word": " ?gbm! ", "start": -1, "end": 2}]
    assert [s[:4] for s in spans(payloads.token_class_to_annotations(of(spark, items), docs, "apollo"))] == [("the cat", 27, 34, "problem"), ("gbm", 14, 17, "o"), ("gbm", 14, 17, "x")]
    assert [s[:4] for s in spans(payloads.token_class_to_annotations(of(spark, items), docs, "biobert", "typed", "gene"))] == [("the cat", 27, 34, "gene"), ("gbm", 14, 17, "gene")]
    assert [s[:3] for s in spans(payloads.token_class_to_annotations(of(spark, items), docs, "clinicalbert", "clinical"))][0] == ("cat", 31, 34)
    flat = [{"mention": "gbm", "obj": "Disease", "span": {"begin": 14, "end": 17}, "id": ["A", "B"], "prob": 0.25}, {"obj": "p53", "db_id": "-"}]
    want = [("gbm", 14, 17, "disease", "A", None, 0.25), ("p53", 22, 25, "p53", None, None, None)]
    for payload in ({"annotations": flat}, {"entities": flat}, flat):
        assert spans(payloads.flat_json_to_annotations(of(spark, payload), docs)) == want
    assert len(spans(payloads.flat_json_to_annotations(of(spark, flat[0]), docs))) == 1
    kb = spark.createDataFrame([("C1", " Name ")], "id string, name string")
    linked = [{"text": "gbm", "label": "ENTITY", "start": 14, "end": 17, "kb_ents": [["C1", 0.9], ["C2", 0.8]]}, {"text": "p53", "label": "ENTITY", "start": 22, "end": 25, "kb_ents": []}]
    assert spans(payloads.span_records_to_annotations(of(spark, linked), docs, "scispacy_md", kb)) == [("gbm", 14, 17, "biomedical_entity", "C1", "Name", 0.9), ("p53", 22, 25, "biomedical_entity", None, None, None)]


def test_concept_payloads(spark, docs):
    r = {"source_value": "gbm", "start": 14, "end": 17, "cui": "C1", "pretty_name": "N", "acc": 0.7, "types": ["", "T1"]}
    for payload in ({"result": {"annotations": {"entities": {"0": r}}}}, {"result": {"annotations": [{"0": r}]}}, {"entities": {"0": r}}, [r], r, {"annotations": [r]}):
        assert spans(payloads.medcat_to_annotations(of(spark, payload), docs)) == [("gbm", 14, 17, "t1", "C1", "N", 0.7)]
    many = {"entities": {str(i): {"cui": f"C{i}", "source_value": "gbm"} for i in (0, 10, 2)}}
    assert [x.canonical_id for x in payloads.medcat_to_annotations(of(spark, many), docs).orderBy("ordinal").collect()] == ["C0", "C2", "C10"]
    assert spans(payloads.medcat_to_annotations(of(spark, [r]), docs, min_accuracy=0.8)) == [] and spans(payloads.medcat_to_annotations(of(spark, "{bad"), docs)) == []


def test_gold_rows(spark):
    from spanloom.operators.corpus_stats import CORPUS_ROW

    entity = ("", "SpecificDisease", ["heart attack"], [[120, 132]], [("MESH", "D1"), ("", "x")])
    rows = spark.createDataFrame([("1", [("title", ["A title"], [[0, 7]]), ("abstract", ["Has heart attack."], [[116, 133]])], [entity, ("T2", "Gene", ["x"], [[1, 2]], []), ("T3", "disease", ["x"], [], []), ("T4", "Modifier", ["bad"], [[0, 1]], [])], None)], CORPUS_ROW)
    gold, warnings = records.bigbio_gold(rows)
    a, b = gold.orderBy("ordinal").collect()
    assert (a.annotation_id, a.start, a.end, a.normalized_ids, a.entity_type) == ("1:gold:0", 13, 25, ["MESH:D1", "x"], "disease") and (b.start, b.end) == (0, 1)
    assert {(r["index"], r.warning) for r in warnings.collect()} == {(1, "unsupported_type"), (2, "no_offsets"), (3, "text_mismatch")}


PUBMED = """<PubmedArticle><MedlineCitation Status="MEDLINE" Owner="NLM"><PMID Version="1">7</PMID><DateRevised><Year>2020</Year><Month>3</Month></DateRevised>
<Article><Journal><ISSN IssnType="Print">1-2</ISSN><JournalIssue><Volume>5</Volume><PubDate><MedlineDate>2019 Spring</MedlineDate></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>On <i>p53</i> genes</ArticleTitle><Abstract><AbstractText Label="AIM" NlmCategory="OBJ">To <b>see</b>.</AbstractText><AbstractText>Done.</AbstractText></Abstract>
<AuthorList><Author><LastName>L</LastName><Identifier Source="ORCID">https://orcid.org/0-1</Identifier><AffiliationInfo><Affiliation>U</Affiliation></AffiliationInfo></Author><Author><CollectiveName>G</CollectiveName><AffiliationInfo><Affiliation>U</Affiliation></AffiliationInfo></Author></AuthorList></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="Y">X</DescriptorName><QualifierName UI="Q1">q</QualifierName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><History><PubMedPubDate PubStatus="medlinerec"><Year>2018</Year><Month>1</Month><Day>2</Day></PubMedPubDate></History><ArticleIdList><ArticleId IdType="pmc">12</ArticleId><ArticleId IdType="doi">10.1/x</ArticleId></ArticleIdList>
<ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/other</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>"""


def test_pubmed_records(spark):
    df = pubmed.split_articles(spark.createDataFrame([(f"<Set>{PUBMED}{PUBMED}</Set>",)], "value string"))
    rows = pubmed.pubmed_xml_to_records(df.unionByName(spark.createDataFrame([("<broken",), (None,)], "xml string"))).collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.pmid, r.version, r.pmcid, r.doi, r.title, r.abstract, r.year, r.pub_date, r.medline_date, r.revision_date) == ("7", "1", "PMC12", "10.1/x", "On p53 genes", "AIM: To see. Done.", "2019 Spring", "2019 Spring", "2018-01-02", "2020-03-01")
    assert r.affiliations == ["U"] and r.authors[0].orcid == "0-1" and r.mesh_terms[0].major_topic and r.mesh_terms[0].qualifiers[0].name == "q" and r.grants == []


RICH = """<PubmedArticle xmlns:mml="m"><MedlineCitation Status="X" Owner="NLM"><PMID Version="2"> 8 </PMID><!-- <PMID>no</PMID> --><DateRevised><Year>2021</Year></DateRevised>
<Article PubModel="Print"><Journal><ISSN>9-9</ISSN><JournalIssue CitedMedium="Internet"><Volume>1</Volume><Issue>2</Issue><PubDate><Year>2019</Year><Month>Mar</Month><Day>5</Day></PubDate></JournalIssue><Title>A &amp; B</Title><ISOAbbreviation>AB</ISOAbbreviation></Journal>
<ArticleTitle>x &lt;i&gt; <i>a<sub>2</sub></i> <mml:math><mml:mi>q</mml:mi></mml:math>&quot;<b/></ArticleTitle><Pagination><MedlinePgn>1-2</MedlinePgn></Pagination>
<Abstract><AbstractText Label=" A ">One <i>two</i>
three</AbstractText><AbstractText Label="B"> </AbstractText><AbstractText>&#233;&#x1F600;</AbstractText><CopyrightInformation>no</CopyrightInformation></Abstract>
<AuthorList CompleteYN="Y"><Author ValidYN="Y"><LastName>Ö</LastName><ForeName>F</ForeName><Initials>F</Initials><Identifier Source="other">1</Identifier><Identifier Source="orcid">https://orcid.org/2</Identifier><AffiliationInfo><Affiliation>U1</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>U2 <i>x</i></Affiliation></AffiliationInfo></Author><Author/></AuthorList>
<Language>eng</Language><Language>ger</Language><GrantList><Grant><GrantID>G1</GrantID><Acronym>AC</Acronym><Agency>NIH</Agency><Country>US</Country></Grant><Grant><Agency>B</Agency></Grant></GrantList>
<PublicationTypeList><PublicationType UI="D1">Review</PublicationType><PublicationType UI="D2">Letter</PublicationType></PublicationTypeList><DataBankList><DataBank><DataBankName>GEO</DataBankName><AccessionNumber>1</AccessionNumber><AccessionNumber>2</AccessionNumber></DataBank></DataBankList>
<ArticleDate DateType="Print"><Year>2000</Year></ArticleDate><ArticleDate DateType="Electronic"><Year>2019</Year><Month>02</Month><Day>1</Day></ArticleDate></Article>
<MedlineJournalInfo><Country>UK</Country><MedlineTA>TA</MedlineTA><NlmUniqueID>55</NlmUniqueID><ISSNLinking>7-7</ISSNLinking></MedlineJournalInfo>
<ChemicalList><Chemical><RegistryNumber>0</RegistryNumber><NameOfSubstance UI="C1">Water</NameOfSubstance></Chemical></ChemicalList><SupplMeshList><SupplMeshName Type="Disease" UI="S1">S</SupplMeshName></SupplMeshList><GeneSymbolList><GeneSymbol>p53</GeneSymbol></GeneSymbolList>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1">X</DescriptorName><QualifierName UI="Q1" MajorTopicYN="Y">q</QualifierName><QualifierName UI="Q2"> </QualifierName></MeshHeading><MeshHeading><QualifierName>lost</QualifierName></MeshHeading></MeshHeadingList>
<KeywordList Owner="N"><Keyword MajorTopicYN="N">k1</Keyword><Keyword> </Keyword></KeywordList><KeywordList Owner="M"><Keyword>k <i>2</i></Keyword></KeywordList></MedlineCitation>
<PubmedData><History><PubMedPubDate PubStatus="Received"><Year>2018</Year><Month>1</Month></PubMedPubDate><PubMedPubDate PubStatus="accepted"><Month>1</Month></PubMedPubDate><PubMedPubDate PubStatus="medline"><Year>2017</Year></PubMedPubDate><PubMedPubDate PubStatus="entrez"><Year>1</Year></PubMedPubDate><PubMedPubDate PubStatus="entrez"><Year>2</Year></PubMedPubDate></History>
<CommentsCorrectionsList><CommentsCorrections RefType="Cites"><RefSource>s</RefSource><PMID Version="1">99</PMID></CommentsCorrections></CommentsCorrectionsList><ArticleIdList><ArticleId IdType="PMC">PMC5</ArticleId><ArticleId IdType="pii">S</ArticleId><ArticleId IdType="doi">a</ArticleId><ArticleId IdType="doi">b</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""


def test_pubmed_records_against_an_xml_tree(spark, tmp_path):
    """Every field, on rich, poor and broken articles, read from files that are cut in the middle of articles."""
    articles = [RICH, PUBMED, "<PubmedArticle></PubmedArticle>", "<PubmedArticle><MedlineCitation><PMID>1</PMID></MedlineCitation></PubmedArticle>", "<PubmedArticle a='1'><PubmedData><History></PubmedArticle>"]
    (tmp_path / "x.xml").write_text('<?xml version="1.0"?>\n<PubmedArticleSet>\n' + "\n".join(articles * 5) + "\n</PubmedArticleSet>\n")
    (tmp_path / "y.xml").write_text("<PubmedArticleSet></PubmedArticleSet>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        read = pubmed.read_pubmed_xml(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 5 and sorted(r.xml for r in read.collect()) == sorted(articles * 5)
        rows = [r.asDict(recursive=True) for r in pubmed.pubmed_xml_to_records(read).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [r for x in articles if (r := plain_pubmed.pubmed_record(x)) is not None] * 5
    text = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(text, rows)) == sorted(map(text, want)) and len(want) == 20


def test_full_text_and_services(spark):
    xml = "<article><front><p>no</p></front><body><sec><title>T</title><p>a  <i>b</i></p><p>a b</p></sec></body></article>"
    assert records.jats_to_plain(xml) == "T\n\na b" and records.jats_to_plain("<x") == "" and records.jats_to_plain("<a/>") == ""
    documents = spark.createDataFrame([("1", "PMC1", None), ("2", None, False), ("3", None, None), ("4", "PMC4", None), ("5", "PMC5", None)], "document_id string, pmcid string, in_pmc boolean")
    texts = spark.createDataFrame([("PMC1", xml), ("PMC4", "<a/>"), ("PMC5", None)], "pmcid string, xml string")
    got = {r.document_id: (r.full_text_status, r.full_text) for r in records.attach_full_text(documents, texts).collect()}
    assert got == {"1": ("ok", "T\n\na b"), "2": ("not_in_pubmed_central", None), "3": ("no_pmcid_in_record", None), "4": ("empty_after_parse", None), "5": ("failed", None)}
    links = {"linksets": [{"ids": ["7"], "linksetdbs": [{"linkname": "pubmed_pubmed", "links": [{"id": "8", "score": 5}, "9"]}, {"linkname": "pubmed_pubmed_refs", "links": [10]}]}, {"ids": ["1"], "linksetdbs": [{"linkname": "pubmed_pubmed", "links": ["3"]}]}]}
    df = spark.createDataFrame([("7", json.dumps(links))], "pmid string, payload string")
    assert {tuple(r) for r in records.enrichment_links(df).collect()} == {("7", "related", "8", 5), ("7", "related", "9", 0), ("7", "references", "10", None)}
    oa = spark.createDataFrame([("10.1/x", json.dumps({"is_oa": True, "oa_status": "gold", "best_oa_location": {"url_for_pdf": "u", "license": "cc"}})), ("10.1/y", "{bad")], "doi string, payload string")
    assert [tuple(r) for r in records.open_access(oa).collect()] == [("10.1/x", True, "gold", "u", "cc")]
    pre = spark.createDataFrame([("10.1101/a", "medrxiv", json.dumps({"collection": [{"version": "1"}]})), ("10.1101/a", "biorxiv", json.dumps({"collection": [{"version": "1"}, {"version": "2"}]})), ("10.5/a", "biorxiv", json.dumps({"collection": [{"version": "1"}]}))], "doi string, server string, payload string")
    assert [(r.doi, r.server, json.loads(r.record)["version"]) for r in records.preprints(pre).collect()] == [("10.1101/a", "biorxiv", "2")]
    cites = spark.createDataFrame([("7", "s2", json.dumps({"references": [{"id": 1}, {"id": 2}], "citations": [{"id": 3}]}))], "pmid string, service string, payload string")
    assert sorted((r.direction, r.target) for r in records.citation_edges(cites).collect()) == [("citations", '{"id":3}'), ("references", '{"id":1}'), ("references", '{"id":2}')]


def test_files(spark, tmp_path):
    table = tmp_path / "t.tsv"
    table.write_text('document_id\ttitle\tabstract\tnote\n d1 \t T\t"multi\nline"\tn\nd2\t\tA\t\n')
    rows = {r.document_id: r for r in files.read_text_table(spark, str(table), "tsv").collect()}
    assert (rows["d1"].title, rows["d1"].abstract, rows["d1"].metadata, rows["d2"].title) == ("T", "multi\nline", {"note": "n"}, "")
    for fmt, text, message in (("xls", "x", "unsupported"), ("csv", "a,b\n1,2\n", "lacks"), ("csv", "document_id,title,abstract\n ,t,a\n", "blank")):
        (tmp_path / "bad").write_text(text)
        with pytest.raises(ValueError, match=message):
            files.read_text_table(spark, str(tmp_path / "bad"), fmt)
    corpus = tmp_path / "c.json"
    for wrap in (lambda x: x, lambda x: {"documents": x}):
        corpus.write_text(json.dumps(wrap([{"pmid": "5", "title": " T "}, {"title": "x", "source": " "}, {"document_id": "z"}])))
        assert [(r.document_id, r.title, r.source) for r in files.read_corpus_json(spark, str(corpus)).collect()] == [("PMID:5", "T", "corpus"), ("CORPUS:1", "x", "corpus"), ("z", "", "corpus")]
    (tmp_path / "ids").write_text("PMID: 1\n\n 2 \n")
    assert [r.pmid for r in files.read_id_list(spark, str(tmp_path / "ids")).collect()] == ["1", "2"]
    (tmp_path / "raw").write_text("one\n\n  two \nthree\n")
    assert sorted(map(tuple, files.read_raw_text_lines(spark, str(tmp_path / "raw")).collect())) == [("text-1", "one"), ("text-2", "two"), ("text-3", "three")]
    (tmp_path / "iob").write_text('{"id":"1","tokens":["a"],"ner_tags":[1]}\n\n')
    assert files.read_iob_jsonl(spark, str(tmp_path / "iob")).count() == 1
    docs = spark.createDataFrame([("a|b", "x\ny")], "document_id string, text string")
    sinks.write_pubtator(docs, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).where("value <> ''").count() == 2 and sinks.pubtator_export(docs).first().title_line == "a_b|t|x y"
    sinks.write_results({"docs": docs}, str(tmp_path / "run"))
    sinks.write_tsv(docs, str(tmp_path / "tsv"))
    sinks.write_jsonl(docs, str(tmp_path / "jsonl"))
    sinks.write_id_list(spark.createDataFrame([("1",)], "pmid string"), str(tmp_path / "idlist"))
    assert spark.read.parquet(str(tmp_path / "run" / "docs")).count() == 1


def test_nested_results(spark, tmp_path):
    """A document's lists in their order, long documents in several lines, and a manifest counted from the files."""
    docs = spark.createDataFrame([("a", 'T "1"'), ("b", None), ("c\\", "x")], "document_id string, title string")
    rows = [("a", f"x:{i}", "x" if i % 2 else "y", i * 10, i * 10 + 3, i % 2, i) for i in range(30)] + [("b", "x:n", "x", None, None, 0, 1)]
    annotations = spark.createDataFrame(rows, "document_id string, annotation_id string, source string, start int, end int, source_rank int, ordinal int")
    keywords = spark.createDataFrame([("a", "k2", 7, 9), ("a", "k1", 7, 9), ("a", "k3", None, None), ("a", "k4", 150, 151)], "document_id string, keyword string, start int, end int")
    statuses = spark.createDataFrame([("a", "y", "ok"), ("a", "x", "ok"), ("b", "x", "failed")], "document_id string, name string, status string")
    lines = sinks.results_lines(docs, annotations, keywords, statuses, line_chars=100)
    sinks.write_results_lines(lines, spark.createDataFrame([(3,)], "seen int"), str(tmp_path / "out"))
    found = {(x["document_id"], x["part"]): x for x in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/lines")).collect())}
    assert set(found) == {("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c\\", 0)}
    assert found["a", 0]["document"] == {"title": 'T "1"'} and found["a", 1]["document"] is None and found["b", 0]["document"] == {"title": None}
    assert [x["annotation_id"] for x in found["a", 0]["annotations"]] == [f"x:{i}" for i in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)] and len(found["a", 2]["annotations"]) == 10
    assert [x["keyword"] for x in found["a", 0]["keywords"]] == ["k1", "k2", "k3"] and [x["name"] for x in found["a", 0]["annotators"]] == ["x", "y"]
    assert found["b", 0]["annotations"] == [{"annotation_id": "x:n", "source": "x", "start": None, "end": None}]
    manifest = json.loads(spark.read.text(str(tmp_path / "out/manifest")).first().value)
    assert manifest == {"document_count": 3, "line_count": 5, "annotation_count": 31, "keyword_count": 4, "run_seen": 3}
