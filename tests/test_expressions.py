import pytest
from pyspark.sql import functions as F

from spanloom.functions import identifiers as I
from spanloom.functions import text as T
from spanloom.functions import vocab as V
from spanloom.operators import harmonize as H


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, x string" + (", y string" if isinstance(rows[0], tuple) else ""))
    return [tuple(r[1:]) if len(columns) > 1 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def test_fold_and_strip(spark):
    assert values(spark, ["Straße", "ΣΑΣ", None], T.fold("x")) == ["strasse", "σασ", None]
    assert values(spark, ["  a b\t\n", ""], T.strip("x")) == ["a b", ""]


def test_document_text(spark):
    rows = [(" T ", "A\n"), ("", " A"), (None, None), ("T", " ")]
    assert values(spark, rows, T.document_text("x", "y")) == ["T\n\nA", "A", "", "T"]


def test_trim_boundary_and_determiner(spark):
    out = T.trim_boundary(F.col("x"), F.lit(10))
    assert values(spark, ['("tumour").', "..", "p53"], *out) == [("tumour", 12, 18), ("", 10, 10), ("p53", 10, 13)]
    assert values(spark, ["The  cat", "theory", "these"], *T.strip_determiner(F.col("x"), F.lit(0))) == [("cat", 5), ("theory", 0), ("these", 0)]
    assert values(spark, ["the", " -", "a", "p5", "--", "x/"], T.is_noise(F.col("x"))) == [True, True, True, False, True, True]


def test_entity_types(spark):
    labels = ["Gene / protein", " CellLine ", "DISEASE_DISORDER", "My-Type", "", None, "Chemical"]
    assert values(spark, labels, V.normalize_entity_type("x")) == ["gene", "cell_line", "disease", "my_type", "unknown", "unknown", "drug"]
    assert V.type_choices(["clinicalbert", "bern2"])[:3] == ["gene", "disease", "drug"] and V.type_choices(["clinicalbert"]) == ["problem", "test", "treatment"]


def test_identifiers(spark):
    assert values(spark, ["pmid: 12 ", "PMID:", " 7"], I.normalize_pmid("x")) == ["12", None, "7"]
    assert values(spark, ["pmc:12", "PMC12", "12", "PMCx"], I.normalize_pmcid("x")) == ["PMC12", "PMC12", "PMC12", None]
    aliases = lambda r: [sorted(a) for a in values(spark, r, I.prediction_aliases("x"))]
    assert aliases(["msh:D1", "['MESH:D1', 'MIM:7']", "a; b|'c'", "-", None, "x:"]) == [["D1", "MESH:D1"], ["7", "D1", "MESH:D1", "OMIM:7"], ["A", "B", "C"], [], [], ["X"]]
    assert values(spark, ["mesh:D1", "['mesh:D1','x']", None, "[broken"], I.joined_identifiers("x")) == ["MESH:D1", "MESH:D1|x", "", "[broken"]
    assert values(spark, [("7", "gene"), ("cvcl:1", "cell_line"), ("CVCL:CVCL_1", ""), ("go:1", ""), ("zz:1", "")], I.database_link("x", "y")) == ["https://www.ncbi.nlm.nih.gov/gene/7", "https://www.cellosaurus.org/CVCL_1", "https://www.cellosaurus.org/CVCL_1", "https://purl.obolibrary.org/obo/GO_1", None]
    assert values(spark, [("7", "species"), ("taxon:9", ""), ("zz:1", ""), (None, "")], I.format_identifier("x", "y")) == ["NCBITaxon:7", "NCBITaxon:9", "zz:1", ""]


def test_make_annotations(spark):
    rows = [("d", "s", " gbm ", "Disease", None, 3, "-", " ", "0.5", 1, 0, "a gbm here"), ("d", "s", "gbm", "Disease", 2, 5, "MESH:D1", "n", "x", 2, 0, "a gbm here"), ("d", "s", "zzz", None, None, None, None, None, "", 3, 0, "a gbm here")]
    df = spark.createDataFrame(rows, "document_id string, source string, span_text string, entity_type string, start int, end int, canonical_id string, canonical_name string, confidence string, ordinal int, source_rank int, text string")
    a, b, c = H.make_annotations(df, "text").orderBy("ordinal").collect()
    assert (a.start, a.end, a.canonical_id, a.canonical_name, a.confidence, a.annotation_id) == (2, 5, None, None, 0.5, b.annotation_id)
    assert b.confidence is None and (c.start, c.end, c.entity_type) == (None, None, "unknown")
    import hashlib

    assert a.annotation_id == "s:" + hashlib.sha1(b"s|d|disease|2|5|gbm").hexdigest()[:12]
    assert c.annotation_id == "s:" + hashlib.sha1(b"s|d|unknown|None|None|zzz").hexdigest()[:12]


@pytest.mark.parametrize(("threshold", "default", "n"), [(0.5, None, 1), (0, 0.9, 3), (None, None, 3), (None, 0.9, 0)])
def test_min_confidence(spark, threshold, default, n):
    df = spark.createDataFrame([("0.6",), (None,), ("x",)], "confidence string")
    assert H.min_confidence(df, threshold, default).count() == n
