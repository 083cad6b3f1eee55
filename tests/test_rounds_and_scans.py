"""Two-level scans and the operators that work in rounds, with ranges and blocks far smaller than usual."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.operators import agreement, corpus_stats, matching, report_stats, scans
from spanloom.operators.scans import running

from .test_operators import annotations, naive


@pytest.fixture(params=[3, 1 << 16])
def width(request, monkeypatch):
    monkeypatch.setattr(scans, "WIDTH", request.param)


def test_running_values_against_loops(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(40), i, rng.choice([None, rng.randrange(9)])) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, at int, i int, x int").repartition(7)
    values = {"top": ("max", "x", True), "low": ("min", "x", False), "total": ("sum", "x", False), "seen": ("last", "x", False), "ahead": ("min", "x", False, True), "later": ("last", "x", True, True)}
    got = {r.i: r for r in running(df, ["k"], ["at", "i"], values, back=[-F.col("at"), F.col("i")], width=4).collect()}
    assert len(got) == 150
    for k, at, i, x in rows:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        n = own.index((k, at, i, x))
        before, upto = [r[3] for r in own[:n] if r[3] is not None], [r[3] for r in own[: n + 1] if r[3] is not None]
        back = sorted(own, key=lambda r: (-r[1], r[2]))
        m = back.index((k, at, i, x))
        after, fromhere = [r[3] for r in back[:m] if r[3] is not None], [r[3] for r in back[: m + 1] if r[3] is not None]
        r = got[i]
        assert (r.top, r.low, r.total, r.seen) == (max(upto, default=None), min(before, default=None), sum(before), before[-1] if before else None)
        assert (r.ahead, r.later) == (min(after, default=None), fromhere[-1] if fromhere else None)


def _frames(spark, p_rows, g_rows):
    return spark.createDataFrame(p_rows, "document_id string, source string, i int, start int, end int"), spark.createDataFrame(g_rows, "document_id string, j int, start int, end int")


@pytest.mark.parametrize("best", [False, True])
def test_matching_rounds_across_blocks(spark, best):
    """Spans longer than a block, orders that have nothing to do with positions, two annotators."""
    rng, p_rows, g_rows, want = random.Random(2), [], [], set()
    span = lambda: (s := rng.randrange(60), s + rng.randrange(1, 14))
    for d in range(12):
        g = [(j + 1, *span()) for j in range(rng.randrange(25))]
        g_rows += [(f"d{d}", *x) for x in g]
        for source in "xy":
            p = [(i + 1, *span()) for i in range(rng.randrange(25))]
            p_rows += [(f"d{d}", source, *x) for x in p]
            rule = lambda s, e, a, b: None if max(s, a) >= min(e, b) else max(s, a) - min(e, b) if best else 0
            want |= {(f"d{d}", source, i, j) for i, j in naive(p, g, rule)}
    got = matching._greedy(*_frames(spark, p_rows, g_rows), best, block=8, task_rows=40).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_a_refusal_runs_through_all_blocks(spark):
    """Prediction 1 takes the gold span of prediction 2, which takes that of 3, and so on to the end of the document."""
    n = 400
    p_rows = [("d", "x", 1, 0, 1)] + [("d", "x", i + 2, 10 * i, 10 * i + 11) for i in range(n)]
    g_rows = [("d", i + 1, 10 * i, 10 * i + 10) for i in range(n + 1)]
    got = sorted((r.i, r.j) for r in matching._greedy(*_frames(spark, p_rows, g_rows), False, block=1000).collect())
    assert got == [(i, i) for i in range(1, n + 2)]
    assert matching._greedy(*_frames(spark, [], []), False).collect() == []


def test_nearest_spans_over_ranges(spark, width):
    rng = random.Random(4)
    span = lambda: (s := rng.randrange(300), s + rng.randrange(1, 9))
    p_rows = [("d%d" % (i % 4), "x", i, *span()) for i in range(60)]
    g_rows = [("d%d" % (j % 3), j, *span()) for j in range(30)]
    p, g = _frames(spark, p_rows, g_rows)
    for r in matching.nearest_span(p, g, ["document_id"], "j").collect():
        want = min(((max(r.start - b, a - r.end, 0), j) for d, j, a, b in g_rows if d == r.document_id), default=(None, None))
        assert (r.nearest_distance, r.nearest_ordinal) == want


def test_highlights_over_ranges(spark, width):
    """One chain over the whole document: what is kept follows from its head by many jumps."""
    rng = random.Random(5)
    rows = [("d", "xyz"[rng.randrange(3)], f"w{i}", (a := rng.randrange(500)), a + rng.randrange(2, 9), "gene", None, None) for i in range(900)]
    df = annotations(spark, rows)
    want, last = set(), -1
    spans = [r.asDict() for r in df.collect()]
    for s in sorted(spans, key=lambda s: (s["start"], {"y": 0, "x": 1}.get(s["source"], 99), s["start"] - s["end"], s["source_rank"], s["ordinal"], s["annotation_id"])):
        if s["start"] >= last:
            last = s["end"]
            want.add((s["annotation_id"], s["start"], s["end"]))
    got = [(r.annotation_id, r.start, r.end) for r in report_stats.non_overlapping_spans(df, {"y": 0, "x": 1}).collect()]
    assert len(got) == len(want) > 60 and set(got) == want
    assert report_stats.non_overlapping_spans(df.limit(0)).collect() == []


def test_agreement_over_ranges(spark, width):
    rng = random.Random(6)
    rows = [("d%d" % rng.randrange(3), "xyz"[rng.randrange(3)], f"w{i}", (a := rng.randrange(200)), a + rng.randrange(1, 6), rng.choice(["gene", "disease"]), None, None) for i in range(150)]
    df = annotations(spark, rows)
    want = set()
    for d, kind in {(r[0], r[5]) for r in rows}:
        end = None
        for r in sorted((r for r in rows if (r[0], r[5]) == (d, kind)), key=lambda r: r[3]):
            if end is None or r[3] >= end:
                if end is not None:
                    want.add((d, kind, start, end, "".join(sorted(who))))
                start, end, who = r[3], r[4], {r[1]}
            else:
                end, who = max(end, r[4]), who | {r[1]}
        want.add((d, kind, start, end, "".join(sorted(who))))
    got = [(r.document_id, r.entity_type, r.start, r.end, "".join(r.annotators)) for r in agreement.agreement_groups(df, 3).collect()]
    assert len(got) == len(want) and set(got) == want


def test_mentions_of_long_sequences(spark, width):
    rng = random.Random(7)
    rows = [(f"s{i}", [f"t{k}" for k in range(n)], [rng.choice([0, 0, 1, 2, 2, 9]) for _ in range(n)]) for i, n in enumerate([0, 1, 5, 40, 200])]
    wide = spark.createDataFrame(rows, corpus_stats.IOB_ROW)
    long = wide.select("id", F.posexplode(F.arrays_zip("tokens", "ner_tags")).alias("position", "x")).select("id", "position", F.col("x.tokens").alias("token"), F.col("x.ner_tags").alias("ner_tag"))
    got = corpus_stats.iob_token_mentions(long).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in corpus_stats.iob_mentions(wide).collect()} and len(got) > 40


def test_one_round_over_arrays_gives_the_serial_matches(monkeypatch):
    rng, columns = random.Random(5), [c.split()[0] for c in matching._EDGES.split(", ")]
    for few in (1, 3, 10**6):
        monkeypatch.setattr(matching, "FEW", few)
        rows, want = [], set()
        for doc in "de":
            for source in ("a", "b"):
                edges = {(i, j): rng.randrange(4) for i in range(40) for j in range(max(0, i - 3), i + 3) if rng.random() < 0.6}
                rows += [(doc, source, 0, matching.EDGE, i, j, rank, 0) for (i, j), rank in edges.items()]
                used = set()
                for i in range(40):
                    if free := [(rank, j) for (a, j), rank in edges.items() if a == i and j not in used]:
                        used.add(min(free)[1])
                        want.add((doc, source, i, min(free)[1]))
        rng.shuffle(rows)
        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=columns)
        got = matching._settled_at_once(table)
        assert got.schema.types == types
        assert {(r["document_id"], r["source"], r["i"], r["j"]) for r in got.to_pylist()} == want and len(got) == len(want)
        assert {(r["document_id"], r["source"], r["i"], r["j"]) for r in matching._settled(table, True, False).to_pylist() if r["kind"] == matching.HELD} == want
