"""How often queries shuffle: rows that lie by document already stay where they are."""

import re

import pytest
from pyspark.sql import functions as F

from spanloom.operators import agreement, corpus_stats, keywords, matching, sinks
from spanloom.plans import annotate_queries as AQ
from spanloom.plans import corpus_queries as CQ
from spanloom.plans import file_queries as FQ
from spanloom.plans import fixtures as X
from spanloom.plans import payload_queries as PQ
from spanloom.plans import scoring_queries as SQ
from spanloom.sources import payloads


@pytest.fixture
def plan(spark):
    """The plan of a frame whose tables are too large to broadcast."""
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in options.items():
        spark.conf.set(key, value)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for key in options:
        spark.conf.unset(key)


def test_payloads_stay_by_document(spark, data, plan):
    # documents before their tokens are cut, spans by document, documents that payloads meet
    for query in (PQ.s10_pubtator_text_to_annotations, PQ.s10_pubtator_text_without_ids, PQ.s11_brat_to_annotations):
        found = plan(query(spark, data))
        assert found.count("Exchange hashpartitioning") == 3, query.__name__
    # rows of payloads and of their pieces, which alone are dealt again
    assert plan(PQ.s09_pubannotation_to_annotations(spark, data)).count("Exchange hashpartitioning(document_id") <= 5


def test_standoff_lines_of_one_id_meet(spark):
    lines = ["T1\tgene 0 3\tabc", "N1\tReference T1 KB:1\tone", "N2\tReference T9 KB:9\tnone", "T2\tgene 1;2 x\tbad", "T3\tgene 4 9\t", "N3\tOther T1 KB:3\tx", "T4", "T5\tgene 4 5;6 9\tdef", "T1\tcell 1 2\tb", "N4\tReference T1 KB:2", "R1\tx y z\tw"]
    df = spark.createDataFrame([("d", "\n".join(lines)), ("e", "T1\tgene 0 3\tabc"), ("unknown", "T1\tgene 0 3\tabc")], "document_id string, payload string")
    docs = spark.createDataFrame([("d", "t", ""), ("e", "t", "")], "document_id string, text string, title string")
    got = payloads.brat_to_annotations(df, docs).select("document_id", "ordinal", "span_text", "entity_type", "start", "end", "canonical_id", "canonical_name").collect()
    assert sorted(map(tuple, got)) == [("d", 1, "b", "cell", 1, 2, "KB:2", ""), ("d", 2, "def", "gene", 4, 9, None, None), ("e", 1, "abc", "gene", 0, 3, None, None)]


def test_exact_matches_deal_either_side_once(spark, data, plan):
    # documents before their tokens are cut, and spans by document, of either side
    for query in (SQ.j01_strict_match, SQ.j11_normalization_outcome):
        found = plan(query(spark, data))
        assert "Join" not in found, query.__name__
        assert not re.search(r"hashpartitioning\(document_id#\d+, [a-z]", found), query.__name__


def test_rows_are_looked_up_without_a_join(spark):
    rows = spark.createDataFrame([("d", 1, "x"), ("d", 1, "y"), ("d", 2, "z"), ("e", 1, None)], "document_id string, i int, v string")
    table = spark.createDataFrame([("d", 1, [1, 2]), ("e", 1, None), ("f", 1, [3])], "document_id string, i int, w array<int>")
    got = matching.looked_up(rows, table, ["document_id", "i"], ["w"]).select("document_id", "i", "v", F.col("_found").isNotNull(), "_found.w").collect()
    assert sorted(map(tuple, got), key=str) == [("d", 1, "x", True, [1, 2]), ("d", 1, "y", True, [1, 2]), ("d", 2, "z", False, None), ("e", 1, None, True, None)]
    assert [r.v for r in matching.unmatched(rows, table, ["document_id", "i"]).collect()] == ["z"]


def test_digests_are_made_after_rows_are_dealt(spark, data, plan):
    for query in (AQ.a02_keyword_groups, AQ.a03_keyword_mentions, AQ.k03_keyword_evidence):
        found = plan(query(spark, data))
        above, below = found.split("Exchange hashpartitioning(document_id", 1)
        assert "sha1" in above and "sha1" not in below, query.__name__


def test_statuses_need_no_join(spark, data, plan):
    docs = spark.createDataFrame([("d",), ("d",), ("e",), (None,)], "document_id string")
    rows = spark.createDataFrame([("d", "a"), ("d", "a"), ("d", "x"), ("f", "a"), (None, "a")], "document_id string, source string")
    statuses = keywords.annotator_statuses(rows, docs, ["a", "b"])
    assert "Join" not in plan(statuses) and plan(statuses).count("Exchange hashpartitioning") == 1
    got = sorted((str(r.document_id), r.name, r.status, r.annotation_count, r.reason is None) for r in statuses.collect())
    none = [(x, n, "no_annotations", 0, False) for x, n in (("None", "a"), ("None", "b"), ("e", "a"), ("e", "b"))]
    assert got == sorted([("d", "a", "produced_annotations", 2, True), ("d", "b", "no_annotations", 0, False)] * 2 + none)
    # documents before their tokens are cut twice, counts and ids: the statuses of a document lie where its counts do
    assert plan(AQ.a05_document_annotations(spark, data)).count("Exchange hashpartitioning") == 4


def test_aliases_are_made_of_exact_pairs_only(spark, data, plan):
    found = plan(SQ.a09_gold_coverage(spark, data))
    above, below = found[: found.rindex("SortMergeJoin")], found[found.rindex("SortMergeJoin") :]
    assert "rlike" in above.lower() and "rlike" not in below.lower()


def test_corpus_rows_are_put_together_where_tokens_are_cut(spark, data, plan):
    rows = X.bigbio_rows(spark, data)
    for df in (rows, CQ.a17_entities_table(spark, data)):
        assert plan(df).count("Exchange") == 1 and "Join" not in plan(df)
    e = rows.select("doc_id", F.posexplode("entities").alias("n", "e"))
    got = e.select("doc_id", (F.col("n") + 1).alias("ordinal"), "e.id", "e.type", F.col("e.text")[0].alias("t"), F.col("e.offsets")[0][0].alias("s"), F.col("e.offsets")[0][1].alias("x"), F.transform("e.normalized", lambda n: F.concat(n["db_name"], F.lit(":"), n["db_id"])).alias("ids"))
    gold = X.gold_with_text(spark, data)
    want = gold.select("doc_id", "ordinal", F.concat(F.lit("T"), "ordinal"), F.when(F.col("entity_type") == "gene", "Chemical").otherwise("Disease"), "span_text", "start", "end", "normalized_ids")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    relations = {(r.doc_id, *map(tuple, r.relations)) for r in rows.where("entities IS NOT NULL").select("doc_id", F.transform("relations", lambda r: F.concat_ws("-", r["type"], r["arg1_id"], r["arg2_id"])).alias("relations")).select("doc_id", F.transform("relations", lambda r: F.split(r, "-")).alias("relations")).collect()}
    kinds = {}
    for r in gold.orderBy("doc_id", "ordinal").select("doc_id", "ordinal", "entity_type").collect():
        kinds.setdefault(r.doc_id, []).append(r.entity_type)
    assert relations == {(d, *(("CID", f"T{i + 1}", f"T{i + 2}") for i in range(len(k) - 1) if k[i] != k[i + 1])) for d, k in kinds.items()}
    assert rows.count() == X.documents(spark, data).count() and rows.where("entities IS NULL").count() == rows.count() - len(kinds)


def test_columns_of_a_document_are_made_before_its_entities_are_rows(spark, data, plan):
    found = plan(FQ.s05_corpus_rows(spark, data))
    assert found.index("Generate explode") < found.index("md5(")


def test_gold_rows_are_written_compressed(spark, data, tmp_path, monkeypatch):
    path = str(tmp_path / "gold")
    monkeypatch.setattr(FQ, "_folder", lambda _: path)
    n = FQ.k04_gold_rows(spark, data).count()
    files = list((tmp_path / "gold").glob("part-*"))
    assert n == X.gold(spark, data).count() and files and all(f.name.endswith(".json.gz") for f in files)
    sinks.write_jsonl(spark.range(3), str(tmp_path / "plain"))
    assert all(f.name.endswith(".json") for f in (tmp_path / "plain").glob("part-*"))


def test_offsets_meet_a_text_once(spark, data, plan):
    # documents before their tokens are cut, spans and texts
    found = plan(AQ.p06_resolve_offsets(spark, data))
    assert found.count("SortMergeJoin") == 1 and found.count("Exchange hashpartitioning") == 3


def test_merged_candidates_are_sorted_once(spark, plan):
    rows = [("d", 1, 3, "x", "b"), ("d", 1, 3, "x", "a"), ("d", 1, 3, "w", "b"), ("d", 1, 4, "x", "a"), ("d", None, None, "x", "a"), ("e", 1, None, "x", "a"), ("e", 1, None, "y", "a")]
    df = agreement.merge_candidates(spark.createDataFrame(rows, "document_id string, start int, end int, entity_type string, source string"))
    assert sorted(map(tuple, df.collect()), key=str) == [("d", 1, 3, ["w", "x"], ["a", "b"]), ("d", 1, 4, ["x"], ["a"]), ("e", 1, None, ["x", "y"], ["a"])]
    assert plan(df).count("Exchange") == 1 and "Aggregate" not in plan(df)


@pytest.mark.parametrize("width", [1, 2, 5, 1 << 16])
def test_tokens_are_dealt_once(spark, monkeypatch, width):
    monkeypatch.setattr(corpus_stats.scans, "WIDTH", width)
    tags = {"s": "OBIIOIIBBO", "t": "IIIIIIIIII", "u": "OOOO", "v": "B", "w": "OBOOOOOOIB"}
    gaps = lambda n, i: i * 3 if n in "tw" else i  # noqa: E731  # positions without a token
    rows = [(n, gaps(n, i), f"{n}{i}", "OBI".index(t)) for n, x in tags.items() for i, t in enumerate(x)]
    got = corpus_stats.iob_token_mentions(spark.createDataFrame(rows, "id string, position int, token string, ner_tag int"))
    want = [("s", 0, "s1 s2 s3", 3), ("s", 1, "s5 s6", 2), ("s", 2, "s7", 1), ("s", 3, "s8", 1), ("t", 0, " ".join(f"t{i}" for i in range(10)), 10), ("v", 0, "v0", 1), ("w", 0, "w1", 1), ("w", 1, "w8", 1), ("w", 2, "w9", 1)]
    assert sorted(map(tuple, got.collect())) == want
