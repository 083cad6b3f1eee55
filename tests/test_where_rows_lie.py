"""Tables that lie by document: their rows are those of the other form, and what matches them moves nothing else."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import agreement as G
from spanloom.operators import harmonize as H
from spanloom.operators import keywords as K
from spanloom.operators import matching as M
from spanloom.operators import report_stats as R
from spanloom.operators import shared, sinks
from spanloom.plans import annotate_queries as AQ
from spanloom.plans import fixtures as X
from spanloom.plans import report_queries as RQ
from spanloom.plans import scoring_queries as SQ
from spanloom.sources import payloads as P
from tests.test_quick_text import _method_size


@pytest.fixture
def plan(spark):
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in options.items():
        spark.conf.set(key, value)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for key in options:
        spark.conf.unset(key)


def _same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_lying_tables_have_the_same_rows(spark, data, monkeypatch):
    monkeypatch.setattr(X, "ROWS", 100)  # long documents come in several rows
    for of in (X.annotations, X.gold_with_text, X.gold, X.raw_predictions):
        rows, lying = of(spark, data), of(spark, data, dealt=3)
        assert rows.columns == lying.columns and lying.rdd.getNumPartitions() == 3
        assert rows.exceptAll(lying).isEmpty() and lying.exceptAll(rows).isEmpty()


def test_partitions_follow_the_texts(spark, data, monkeypatch):
    assert X.partitions(spark, data) == 4
    monkeypatch.setattr(X, "PARTITION_BYTES", 1 << 14)
    assert X.partitions(spark, data) > 10


def test_only_documents_spans_and_pairs_are_dealt(spark, data, plan):
    for query in (SQ.j03_boundary_match, SQ.a12_boundary_errors, SQ.a12_false_positives, SQ.a12_false_negatives):
        found = plan(query(spark, data))
        assert "Join" not in found, query.__name__
        assert not re.search(r"hashpartitioning\(document_id#\d+, [a-z_]", found), query.__name__
        assert not any("sha1" in x for x in found.split("Exchange")[2:]), query.__name__
    for query in (AQ.a02_keyword_groups, AQ.k03_keyword_evidence):
        assert "array" in plan(query(spark, data)).lower().split("exchange hashpartitioning(document_id")[0]


def _random(spark, seed, n=160):
    r = random.Random(seed)
    spans = lambda m: [(f"d{r.randrange(3)}", s, (a := r.randrange(300)), a + 1 + r.randrange(9)) for s in (r.choice("xy") for _ in range(m))]
    p = [(d, s, i + 1, a, b) for i, (d, s, a, b) in enumerate(spans(n))]
    g = [(d, j + 1, a, b) for j, (d, _, a, b) in enumerate(spans(n))] + [("lone", 500, 2, 4)]
    by = lambda df: df.repartition(4, "document_id")
    return by(spark.createDataFrame([*p, ("none", "x", 900, 1, 3)], "document_id string, source string, i int, start int, end int")), by(spark.createDataFrame(g, "document_id string, j int, start int, end int"))


@pytest.mark.parametrize("width", [4, 512])
def test_overlaps_and_nearest_spans_are_those_of_the_joins(spark, width):
    p, g = _random(spark, width)
    _same(M.overlap_join(p, g, ["document_id"], width), M.overlaps_where_they_lie(p, g, ["document_id"], width))
    for probes, found, keys, ordinal, row in ((p, g, ["document_id"], "j", ["source", "i"]), (g.withColumn("source", F.explode(F.array(F.lit("x"), F.lit("y")))), p, ["document_id", "source"], "i", ["source", "j"])):
        for where in ("true", "start % 40 = 0"):  # dense candidates touch nearly all probes, thin ones hardly any
            want = M.nearest_span(probes, found.where(where), keys, ordinal).select("document_id", *row, "nearest_ordinal", "nearest_distance")
            _same(want, M.nearest_where_they_lie(probes, found.where(where), keys, ordinal, row, width))


@pytest.mark.parametrize("rows", [1, 50, 100_000])
def test_documents_are_settled_where_they_lie(spark, monkeypatch, rows):
    monkeypatch.setattr(M, "ROUND_ROWS", rows)
    p, g = _random(spark, rows)
    strict = M.strict_match(p, g)
    _same(M.lenient_match(p, g), M.lenient_match(p, g, 4))
    _same(M.boundary_match(p, g, strict), M.boundary_match(p, g, strict, 4))
    _same(M._greedy(p, g, True, block=16), M._greedy(p, g, True, block=16, dealt=4))  # documents longer than a block take rounds


def test_reports_by_document_move_nothing_else(spark, data, plan):
    for query in (AQ.j07_resolve_annotation_ids, RQ.w02_non_overlapping_spans, RQ.x01_agreement_groups, RQ.x05_entity_score, RQ.a16_annotator_comparison, SQ.a08_normalization_metrics_lenient):
        found = plan(query(spark, data))
        assert "Join" not in found and "ExistingRDD" not in found, query.__name__
        assert not re.search(r"hashpartitioning\(document_id#\d+, [a-z_]", found), query.__name__
    # of pairs alone identifiers are parsed
    found = plan(SQ.a08_normalization_metrics(spark, data))
    assert "rlike" not in found.lower().split("union", 1)[1]


def test_reports_by_document_are_those_of_the_joins(spark, data):
    rows, lying = X.annotations(spark, data), X.annotations(spark, data, dealt=3)
    _same(K.resolve_annotation_ids(K.keyword_mentions(rows), rows), K.resolve_annotation_ids(K.keyword_mentions(lying, dealt=True), lying, dealt=True))
    _same(G.agreement_groups(rows, 5), G.agreement_groups(lying, 5, dealt=True))
    _same(R.annotator_comparison(rows), R.annotator_comparison(lying, dealt=True))
    types = spark.createDataFrame([("drug", "disease")], "type_a string, type_b string")
    count = lambda df: df.groupBy("document_id", "sentence").count()
    _same(count(G.relation_candidates(rows, X.documents(spark, data), types)), count(G.relation_candidates(lying, X.documents(spark, data), types, 50, dealt=3)))


@pytest.mark.parametrize("rows", [1, 3, 100_000])
def test_spans_to_highlight_are_followed_where_they_lie(spark, monkeypatch, rows):
    r = random.Random(rows)
    monkeypatch.setattr(shared.whole_documents, "__defaults__", (rows,))
    spans = [(f"d{r.randrange(4)}", f"k{n}", r.choice("abc"), (s := r.randrange(120)), s + r.randrange(12), 0, n) for n in range(300)]
    df = spark.createDataFrame([*spans, ("d1", "none", "a", None, 3, 0, 1)], "document_id string, annotation_id string, source string, start int, end int, source_rank int, ordinal int")
    _same(R.non_overlapping_spans(df, {"b": 0}), R.non_overlapping_spans(df.repartition(3, "document_id"), {"b": 0}, dealt=True))


def test_surfaces_travel_where_they_are_not_keys(spark):
    rows = [("e", 0, 1, "GBM", 0, 3), ("d", 0, 1, "Gbm", 0, 3), ("d", 1, 1, "gbm", 0, 3), ("d", 0, 2, "GBM", 5, 8), ("d", 0, 3, "x", 9, 10)]
    df = spark.createDataFrame([(d, r, o, t, s, e, "disease") for d, r, o, t, s, e in rows], "document_id string, source_rank int, ordinal int, span_text string, start int, end int, entity_type string")
    assert [(x.keyword, x.mentions) for x in R.bioconcept_stats(df).orderBy("rank").collect()] == [("Gbm", 2), ("x", 1)]
    assert [(x.keyword, x.mentions) for x in R.bioconcept_stats(df, scope="document").orderBy("rank").collect()] == [("Gbm", 3), ("x", 1)]


def test_slices_of_pieces_are_slices(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 4)
    text = spark.createDataFrame([("ab\n\U0001f600d\u00e9fghijk",), ("",), (None,)], "text string").withColumn("p", T.pieces("text"))
    places = spark.range(-2, 16).selectExpr("CAST(id AS INT) AS s").crossJoin(spark.range(-3, 16).selectExpr("CAST(id AS INT) AS e")).unionByName(spark.createDataFrame([(None, 1), (1, None)], "s int, e int"))
    both = text.crossJoin(places).select("text", "s", "e", T.slice_pieces("p", "text", "s", "e").alias("a"), T.slice_text("text", "s", "e").alias("b"))
    assert both.where("NOT a <=> b").collect() == []


def test_texts_are_measured_and_cut_once(spark, data, plan):
    found = plan(AQ.p18_validate(spark, data))
    assert "regexp_extract_all" in found.split("Join")[1] and "length(text" not in found.split("Join")[0]
    docs = spark.createDataFrame([("d", "abc def"), (None, "abc")], "document_id string, text string")
    spans = [("d", 0, 3, "abc"), ("d", 4, 7, "def"), ("d", 4, 8, "def"), ("d", -1, 2, "abc"), ("d", 4, 4, ""), ("d", 4, 7, "xyz"), (None, 0, 3, "abc"), ("e", 0, 1, "a")]
    got = H.validated(spark.createDataFrame(spans, "document_id string, start int, end int, span_text string"), docs)
    assert sorted((str(r.document_id), r.start, r.end, r.span_text, r.offsets_ok, r.text_ok) for r in got.collect()) == sorted((str(d), s, e, t, d == "d" and 0 <= s < e <= 7, d == "d" and 0 <= s < e <= 7 and t != "xyz") for d, s, e, t in spans)


def test_names_come_to_spans_without_texts(spark, plan, monkeypatch):
    docs = spark.createDataFrame([("d", "some gbm text", "some")], "document_id string, text string, title string")
    kb = spark.createDataFrame([("C1", " gbm ")], "id string, name string")
    records = spark.createDataFrame([("d", '[{"text": "gbm", "label": "x", "kb_ents": [["C1", "0.5"]]}, {"text": "some", "start": 0, "end": 4}]')], "document_id string, payload string")
    for rows in (100, 0):  # a small table of names is sent, a large one is dealt
        monkeypatch.setattr(P, "BROADCAST_ROWS", rows)
        df = P.span_records_to_annotations(records, docs, "s", kb)
        assert ("BroadcastHashJoin" in plan(df)) == (rows > 0) and not re.search(r"Exchange hashpartitioning\(cid[^\n]*\n[^\n]*[\[ ]text#\d+[,\]]", plan(df))
        assert [(r.span_text, r.start, r.end, r.canonical_id, r.canonical_name, r.confidence) for r in df.orderBy("ordinal").collect()] == [("gbm", 5, 8, "C1", "gbm", "0.5"), ("some", 0, 4, None, None, None)]


def test_results_lines_may_be_compressed(spark, data, tmp_path):
    docs = X.documents(spark, data).select("document_id", "pmid", "title", "source")
    none = spark.createDataFrame([], "document_id string, source_rank int, ordinal int, annotation_id string, start int")
    lines = sinks.results_lines(docs, none, spark.createDataFrame([], "document_id string, start int, end int, keyword string"), spark.createDataFrame([], "document_id string, name string"))
    sinks.write_results_lines(lines, K.ingestion_summary(docs), str(tmp_path / "r"), compression="gzip")
    assert all(f.name.endswith(".txt.gz") for f in (tmp_path / "r" / "lines").glob("part-*"))
    assert sinks.read_results_lines(spark, str(tmp_path / "r")).count() == docs.count()


def test_token_records_are_read_in_code_that_compiles(spark, plan):
    docs = spark.createDataFrame([("d", "say, the aspirin! \U0001f600 ok", "say")], "document_id string, text string, title string")
    records = [{"entity_group": "x", "start": 5, "end": 17, "score": 0.5}, {"entity": "y", "word": " ok "}, {"entity_group": "O", "start": 0, "end": 3}, {"start": 9, "end": 2, "word": "(gone)"}, {"word": "..."}, {"start": 3, "end": 5}, {}]
    payload = spark.createDataFrame([("d", json.dumps(records))], "document_id string, payload string")
    got = {v: [(r.ordinal, r.span_text, r.start, r.end, r.entity_type, r.confidence) for r in P.token_class_to_annotations(payload, docs, "s", v, "t" if v == "typed" else None).orderBy("ordinal").collect()] for v in ("plain", "clinical", "typed")}
    assert got["plain"] == [(1, "the aspirin", 5, 16, "x", "0.5"), (2, "ok", 20, 22, "y", None), (3, "say", 0, 3, "O", None), (4, "gone", None, None, None, None)]
    assert got["clinical"] == [(1, "aspirin", 9, 16, "x", "0.5"), *got["plain"][1:]]
    assert got["typed"] == [(1, "the aspirin", 5, 16, "t", "0.5"), (2, "ok", 20, 22, "t", None), (3, "gone", None, None, "t", None)]
    for variant in got:
        df = P.token_class_to_annotations(payload, docs, "s", variant)
        plan(df)
        assert _method_size(spark, df) < 8000, variant
