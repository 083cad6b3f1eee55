import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from spanloom.operators import agreement, annotate, corpus_stats, keywords, matching, merge, metrics, report_stats

ANNOTATION = "document_id string, annotation_id string, source string, span_text string, start int, end int, entity_type string, canonical_id string, canonical_name string, confidence double, ordinal int, source_rank int"


def annotations(spark, rows):
    full = [(d, f"{s}:{i}", s, t, a, b, k, c, None, conf, i, "xyz".index(s)) for i, (d, s, t, a, b, k, c, conf) in enumerate(rows, 1)]
    return spark.createDataFrame(full, ANNOTATION)


def test_keyword_groups(spark):
    df = annotations(spark, [("d", "x", "GBM", 0, 3, "disease", "mesh:D1", 0.1), ("d", "y", "gbm", 0, 3, "disease", "BERN:g", None), ("d", "z", " gbm", 9, 12, "gene", None, None), ("d", "x", "other", None, None, "drug", "['a', 'b']", None), ("d", "x", "  ", 1, 2, "drug", None, None)])
    g = {r.normalized_keyword: r for r in keywords.keyword_groups(df).collect()}
    gbm = g["gbm"]
    assert (gbm.keyword, gbm.annotation_count, gbm.mention_count, gbm.annotator_count, gbm.variants, gbm.canonical_ids, gbm.labels) == ("GBM", 3, 2, 3, ["GBM", "gbm"], ["BERN:g", "MESH:D1"], ["disease", "gene"])
    assert [(m.start, m.annotation_count, m.annotation_ids) for m in gbm.mentions] == [(0, 2, ["x:1", "y:2"]), (9, 1, ["z:3"])]
    assert g["other"].canonical_ids == ["a", "b"] and set(g) == {"gbm", "other"}
    docs = spark.createDataFrame([("d", "7", "T")], "document_id string, pmid string, title string")
    table = {r.keyword: r for r in keywords.keywords_table(keywords.keyword_groups(df), docs).collect()}
    assert (table["GBM"].start, table["GBM"].sources, table["GBM"].pmid) == (0, "x|y|z", "7")
    assert keywords.keyword_evidence(keywords.keyword_groups(df), df, docs).count() == 4
    assert sorted(map(str, keywords.keyword_evidence_table(df, docs).collect())) == sorted(map(str, keywords.keyword_evidence(keywords.keyword_groups(df), df, docs).collect()))


def test_keyword_summaries_agree_with_groups(spark):
    rnd, pick = random.Random(3), lambda *xs: rnd.choice(xs)
    rows = [(pick("d", "e"), pick(*"xyz"), pick("GBM", "gbm ", "a", " ", None), pick(0, 5, None), pick(3, 9, None), pick("disease", "gene", None), pick("mesh:D1", "['a', 'mesh:b']", "-", "", None), None) for _ in range(300)]
    df = annotations(spark, rows)
    again = df.where("ordinal % 3 = 0").withColumns({"ordinal": F.col("ordinal") + 1000, "canonical_id": F.lit("BERN:g")})  # the last row of an id counts
    docs = spark.createDataFrame([("d", "7", "T")], "document_id string, pmid string, title string")
    for part in (df, df.unionByName(again), df.limit(0)):
        tables = [sorted(map(str, keywords.keywords_table(f(part), docs).collect())) for f in (keywords.keyword_groups, keywords.keyword_summaries)]
        assert tables[0] == tables[1]


def naive(predictions, gold, rule):
    used, pairs = set(), []
    for i, s, e in predictions:
        fits = [(rule(s, e, a, b), j) for j, a, b in gold if j not in used and rule(s, e, a, b) is not None]
        if fits:
            used.add(min(fits)[1])
            pairs.append((i, min(fits)[1]))
    return pairs


def test_matching_against_loops(spark):
    rnd, p_rows, g_rows, want = random.Random(1), [], [], {"strict": set(), "lenient": set(), "boundary": set()}

    def span():
        start = rnd.randrange(40)
        return start, start + rnd.randrange(6)

    nearest = {}
    for d in range(40):
        p, g = [(i + 1, *span()) for i in range(rnd.randrange(9))], [(j + 1, *span()) for j in range(rnd.randrange(9))]
        p_rows += [(f"d{d}", "x", *r) for r in p]
        g_rows += [(f"d{d}", *r) for r in g]
        over = lambda s, e, a, b: min(e, b) - max(s, a) if max(s, a) < min(e, b) else None
        strict = naive(p, g, lambda s, e, a, b: 0 if (s, e) == (a, b) else None)
        taken_p, taken_g = {i for i, _ in strict}, {j for _, j in strict}
        want["strict"] |= {(f"d{d}", *x) for x in strict}
        want["lenient"] |= {(f"d{d}", *x) for x in naive(p, g, lambda s, e, a, b: 0 if over(s, e, a, b) else None)}
        want["boundary"] |= {(f"d{d}", *x) for x in naive([x for x in p if x[0] not in taken_p], [x for x in g if x[0] not in taken_g], lambda s, e, a, b: -over(s, e, a, b) if over(s, e, a, b) else None)}
        for i, s, e in p:
            nearest[f"d{d}", i] = min(((max(s - b, a - e, 0), j) for j, a, b in g), default=(None, None))
    p = spark.createDataFrame(p_rows, "document_id string, source string, i int, start int, end int")
    g = spark.createDataFrame(g_rows, "document_id string, j int, start int, end int")
    got = lambda df: {(r.document_id, r.i, r.j) for r in df.collect()}
    strict = matching.strict_match(p, g)
    assert got(strict) == want["strict"] and got(matching.lenient_match(p, g)) == want["lenient"] and got(matching.boundary_match(p, g, strict)) == want["boundary"]
    hits = {(r.document_id, r.i, r.j) for r in matching.overlap_join(p, g, ["document_id"], width=7).collect()}
    assert hits == {(d, i, j) for d, _, i, s, e in p_rows for x, j, a, b in g_rows if d == x and max(s, a) < min(e, b)}
    # an empty candidate span cannot be met by an overlap join of half-open spans, so it is left out here
    solid = g.where("start < end")
    near = {(r.document_id, r.i): (r.nearest_distance, r.nearest_ordinal) for r in matching.nearest_span(p.where("start < end"), solid, ["document_id"], "j").collect()}
    for (d, i), found in near.items():
        s, e = next((s, e) for x, _, k, s, e in p_rows if (x, k) == (d, i))
        assert found == min(((max(s - b, a - e, 0), j) for x, j, a, b in g_rows if x == d and a < b), default=(None, None))


def test_metrics_and_outcomes(spark):
    p = spark.createDataFrame([("d", "x", 1, "MSH:D1"), ("d", "x", 2, None), ("d", "x", 3, "D2"), ("d", "x", 4, "z")], "document_id string, source string, i int, canonical_id string")
    g = spark.createDataFrame([("d", 1, ["MESH:D1", "OMIM:9"]), ("d", 2, ["MESH:D1"]), ("d", 3, ["MESH:D2"]), ("d", 4, [])], "document_id string, j int, normalized_ids array<string>")
    pairs = spark.createDataFrame([("d", "x", i, i) for i in range(1, 5)], "document_id string, source string, i int, j int")
    out = {r.i: (r.outcome, r.all_recovered) for r in metrics.normalization_outcomes(p, g, pairs).collect()}
    assert out[1] == ("correct", False) and out[2][0] == "missing_prediction_id" and out[3] == ("correct", True) and out[4][0] == "missing_gold_id"
    m = metrics.normalization_metrics(metrics.normalization_outcomes(p, g, pairs)).first()
    assert (m.correct, m.all_gold_ids_recovered, m.partially_correct, m.comparable_gold_spans, m.prediction_id_spans) == (2, 1, 1, 3, 3)


def test_merge_and_fallback(spark):
    rows = [("d1", None, " ", "A1", None, "s1", None, {"k": "1"}, "s1"), ("d1", "7", "T2", "A2", "F2", "s2", "2020", {"k": "2", "l": "2", "origin_sources": "x"}, "s2"), ("d2", "8", "", "", "", "s2", "", {}, "s2"), ("d3", "9", "x", "x", None, "s9", None, None, "s9")]
    df = spark.createDataFrame(rows, merge.DOCUMENT + ", origin string")
    got = {r.document_id: r for r in merge.merge_documents(df, ["s1", "s2", "s1"]).collect()}
    a = got["d1"]
    assert (a.pmid, a.title, a.abstract, a.full_text, a.source, a.year, a.origin_sources, a.metadata) == ("7", "T2", "A1", "F2", "s1", "2020", ["s1", "s2"], {"k": "1", "l": "2"})
    assert set(got) == {"d1", "d2"} and got["d2"].title == ""
    with pytest.raises(ValueError, match="unknown fields"):
        merge.project_fields(df, ["nope"], ["title"])


def test_batches_dates_and_windows(spark):
    ids = spark.createDataFrame([(i, str(i % 250)) for i in range(600)], "p int, pmid string").repartition(5)
    got = {r.batch: r.ids for r in merge.request_batches(ids, "pmid", "p", size=100).collect()}
    assert [got[k] for k in sorted(got)] == [[str(i) for i in range(a, min(a + 100, 250))] for a in (0, 100, 200)]
    assert merge.request_batches(ids.where("p < 5"), "pmid", "p").count() == 1
    assert tuple(spark.sql("SELECT array('b', 'a', null, ' ', 'b') AS x").select(merge.distinct_ordered("x")).first())[0] == ["b", "a"]
    dates = spark.createDataFrame([("2020",), ("2020/02",), ("2020-2-29",), ("2019-02-31",), ("x",), (None,)], "t string")
    out = [(r.a and str(r.a), r.b and str(r.b)) for r in dates.select(merge.partial_date("t").alias("a"), merge.partial_date("t", upper=True).alias("b")).collect()]
    assert out == [("2020-01-01", "2020-12-31"), ("2020-02-01", "2020-02-29"), ("2020-02-29", "2020-02-29"), (None, None), (None, None), (None, None)]
    rows = spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i % 9),) for i in range(90)], "d date")
    windows = merge.plan_date_windows(rows, "d", 25)
    assert sum(n for _, _, n in windows) == 90 and all(n <= 25 for _, _, n in windows) and merge.label_windows(rows, "d", windows).count() == 90
    with pytest.raises(ValueError, match="alone"):
        merge.plan_date_windows(rows, "d", 5)


def test_iob_and_corpus_rows(spark):
    rows = spark.createDataFrame([("a", list("pqrstu"), [1, 2, 0, 2, 1, 2]), ("b", ["x"], [0]), ("c", ["x", "y"], [1]), ("d", [], []), ("e", ["x"], [7])], corpus_stats.IOB_ROW)
    got = {(r.id, r.ordinal): (r.mention, r.n_tokens) for r in corpus_stats.iob_mentions(rows).collect()}
    assert got == {("a", 0): ("p q", 2), ("a", 1): ("s", 1), ("a", 2): ("t u", 2)}
    assert {r.tag: r.tokens for r in corpus_stats.tag_counts(rows).collect()} == {"O": 3, "B-GENE": 3, "I-GENE": 3}
    entity = lambda i, kind, text, db: (i, kind, [text], [[0, 1]], [("MESH", db)] if db else [])
    r = spark.createDataFrame([("d", [], [entity("T1", "Chemical", "Old", "C0"), entity("T1", "Chemical", "Chem", "C1"), entity("T2", "Disease", "Dis", None)], [("CID", "T2", "T1"), ("CID", "T1", "T9")]), ("e", [], None, None)], corpus_stats.CORPUS_ROW)
    got = [tuple(x) for x in corpus_stats.relations_table(r).orderBy("ordinal").collect()]
    assert got == [("d", 0, "CID", "Chem", "C1", "Dis", ""), ("d", 1, "CID", "Chem", "C1", "", "")]
    assert tuple(corpus_stats.corpus_counts(r).first()) == (2, 3, 1)


def test_describe_is_interpolated(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (9,)], "x int")
    assert tuple(corpus_stats.describe(df, "x").first()) == (4, 4.0, 1, 3.0, 9)


def test_reports(spark):
    df = annotations(spark, [("d", "x", "a", 0, 1, "Disease", "cui-less", float("nan")), ("d", "y", "A", 0, 1, "disease", None, 0.5), ("e", "x", "a", 0, 1, "disease", "M:1", 0.2), ("d", "z", "bb", 0, 5, "gene", None, None)])
    run = {(r.type, r.keyword): r.mentions for r in report_stats.bioconcept_stats(df).collect()}
    assert run == {("disease", "a"): 1, ("gene", "bb"): 1}
    assert {r.mentions for r in report_stats.bioconcept_stats(df, scope="document").where("type = 'disease'").collect()} == {2}
    hits = {r.key: r for r in report_stats.annotator_comparison(df.where("document_id = 'd'")).collect()}
    assert hits["a"].annotator_count == 2 and [h.confidence for h in hits["a"].hits] == [None, 0.5]
    chosen = report_stats.non_overlapping_spans(df, {"y": 0}).collect()
    assert {(r.document_id, r.source) for r in chosen} == {("d", "y"), ("e", "x")}


def test_agreement(spark):
    df = annotations(spark, [("d", "x", "a", 0, 4, "gene", "mesh:D1", None), ("d", "y", "a", 3, 6, "gene", "MSH:D1", None), ("d", "z", "a", 6, 9, "gene", "D1", None), ("d", "x", "a", 1, 2, "drug", None, None)])
    got = sorted((r.entity_type, r.start, r.end, r.support_count, r.identifier_agreement) for r in agreement.agreement_groups(df, 3).collect())
    assert got == [("drug", 1, 2, 1, False), ("gene", 0, 6, 2, True), ("gene", 6, 9, 1, False)]
    docs = spark.createDataFrame([("d", "One. Two x.")], "document_id string, text string")
    pairs = agreement.relation_candidates(df.where("start < 5"), docs, spark.createDataFrame([("gene", "drug")], "type_a string, type_b string"))
    assert {(r.sentence, r.id_a, r.id_b) for r in pairs.collect()} == {(0, "x:1", "x:4"), (0, "y:2", "x:4")}


def test_run_annotators(spark):
    def good():
        return lambda d, t: [{"span_text": "abc", "entity_type": "Gene", "confidence": 0.5}] if "abc" in t else []

    def broken():
        raise RuntimeError("no model")

    docs = spark.createDataFrame([("d1", "x abc"), ("d2", "y")], "document_id string, text string")
    found, statuses = annotate.split_stream(annotate.run_annotators(docs, {"good": good, "broken": broken}), docs)
    assert [(r.document_id, r.start, r.end, r.entity_type, r.confidence) for r in found.collect()] == [("d1", 2, 5, "gene", 0.5)]
    assert {(r.document_id, r.name): (r.status, r.reason) for r in statuses.collect()} == {("d1", "good"): ("produced_annotations", None), ("d2", "good"): ("no_annotations", "No annotations returned."), ("d1", "broken"): ("failed", "no model"), ("d2", "broken"): ("failed", "no model")}
    with pytest.raises(ValueError, match="unknown annotators"):
        annotate.run_annotators(docs, {"good": good}, known=["other"])


def test_annotators_that_hang_or_die(spark):
    """All other rows stay; after a hang or an abort the annotator is loaded again for the next document."""

    def odd():
        def annotate(document, text):
            if document == "d1":
                time.sleep(60)
            if document == "d2":
                os.abort()
            if document == "d3":
                raise ValueError("no")
            return [{"span_text": text[:1], "entity_type": "gene", "start": 0, "end": 1}]

        return annotate

    def unloadable():
        os._exit(3)

    def hung():
        time.sleep(60)

    good = lambda: lambda document, text: [{"span_text": text, "entity_type": "gene", "start": 0, "end": len(text)}]
    docs = spark.createDataFrame([(f"d{i}", "text") for i in range(6)], "document_id string, text string").coalesce(1)
    stream = annotate.run_annotators(docs, {"odd": odd, "good": good, "unloadable": unloadable, "hung": hung}, deadline={"odd": 1.0}, load_deadline=0.5).collect()
    status = {(r.document_id, r.source): (r.status, r.reason) for r in stream if r.status}
    assert len(status) == 24 and all(status[f"d{i}", "good"][0] == "produced_annotations" for i in range(6))
    assert [status[f"d{i}", "odd"][0] for i in range(6)] == ["produced_annotations", "failed", "failed", "failed", "produced_annotations", "produced_annotations"]
    assert status["d1", "odd"][1] == "annotating took more than 1 s" and "exit code -6" in status["d2", "odd"][1] and status["d3", "odd"][1] == "no"
    assert "exit code 3" in status["d5", "unloadable"][1] and status["d4", "hung"][1] == "loading took more than 0.5 s"
    inside = annotate.run_annotators(docs, {"good": good}, deadline=None).collect()
    assert {tuple(r) for r in inside} == {tuple(r) for r in stream if r.source == "good"}


def test_same_result_under_any_partitioning(spark):
    rows = [("d%d" % (i % 3), "xyz"[i % 3], "word%d" % (i % 5), i % 7, i % 7 + 3, "gene", None, None) for i in range(60)]
    df = annotations(spark, rows)
    want = sorted(map(str, keywords.keyword_groups(df).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert sorted(map(str, keywords.keyword_groups(df.repartition(9)).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_numbers_do_not_depend_on_partitions(spark):
    """Shuffles that are coalesced differently for each plan must not change the numbers."""
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        df = spark.range(n).select((F.col("id") * 7919 % n * 100).alias("position"), F.repeat(F.md5(F.col("id").cast("string")), 5).alias("wide"))
        for columns in (["position", "number"], ["position", "number", "wide"]):
            got = merge.numbered(df, ["position"], "number").select(*columns)
            assert got.where("number IS NULL OR number * 100 <> position").isEmpty() and got.count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_all_subsets_of_annotators(spark):
    names = list("abcdefg")
    vectors = spark.createDataFrame([([0, 1, 2, 3, 0, 0, 0], 2), ([0] * 7, 3), ([3] + [0] * 6, 1)], "states array<int>, gold_count long")
    got = {r.label: r for r in metrics.annotator_combinations(vectors, names).collect()}
    assert len(got) == 127 and got["a+b+c+d+e+f+g"].lenient_count == 3 and got["a+b"].norm_count == 1 and got["b+e"].strict_count == 0 and got["c+g"]["size"] == 2
    assert got["b"].lenient_rate == pytest.approx(2 / 6)
    with pytest.raises(ValueError, match="subsets"):
        metrics.annotator_combinations(vectors, [str(i) for i in range(63)])
    assert metrics.annotator_combinations(vectors.limit(0), names).collect() == []


def test_subsets_of_twenty_annotators(spark):
    rng, names = random.Random(3), [f"n{i}" for i in range(20)]
    rows = [([rng.choice([0, 0, 0, 1, 2, 3]) for _ in names], rng.randrange(1, 9)) for _ in range(60)]
    df = metrics.annotator_combinations(spark.createDataFrame(rows, "states array<int>, gold_count long"), names)
    assert df.count() == 2**20 - 1
    total = sum(n for _, n in rows)
    for r in df.where(F.expr("pmod(hash(label), 20000) = 7 OR size = 20 OR size = 1")).collect():
        best = [max(states[int(a[1:])] for a in r.label.split("+")) for states, _ in rows]
        counts = [sum(n for b, (_, n) in zip(best, rows, strict=True) if b >= level) for level in (1, 2, 3)]
        assert [r.lenient_count, r.strict_count, r.norm_count] == counts and r.strict_rate == pytest.approx(counts[1] / total)


def test_highlighted_spans_against_a_loop(spark):
    rng = random.Random(5)
    rows = [("d%d" % rng.randrange(3), "xyz"[rng.randrange(3)], f"w{i}", (a := rng.randrange(80)), a + rng.randrange(1, 6), "gene", None, None) for i in range(120)]
    df = annotations(spark, rows)
    order = {"y": 0, "x": 1}
    want = set()
    spans = [r.asDict() for r in df.collect()]
    for d in {s["document_id"] for s in spans}:
        last = -1
        for s in sorted((s for s in spans if s["document_id"] == d), key=lambda s: (s["start"], order.get(s["source"], 99), s["start"] - s["end"], s["source_rank"], s["ordinal"], s["annotation_id"])):
            if s["start"] >= last:
                last = s["end"]
                want.add((d, s["annotation_id"], s["start"], s["end"]))
    got = [(r.document_id, r.annotation_id, r.start, r.end) for r in report_stats.non_overlapping_spans(df, order).collect()]
    assert len(got) == len(want) and set(got) == want
