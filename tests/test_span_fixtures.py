import json

import pyarrow as pa

from spanloom.operators import harmonize
from spanloom.plans import fixtures as X
from spanloom.sources import payloads

TEXTS = [(3, "né\nab c.d  zürich 漢字 x end"), (4, ""), (5, "one two\nthree " * 60), (None, "no id here"), (6, " lead\n\ntail "), (7, "😀😀 ok")]


def _plain(doc_id, text):
    """Tokens with offsets, one by one."""
    tokens, at, out = text.replace("\n", " ").split(" "), 0, []
    for pos, token in enumerate(tokens):
        end = at + len(token)
        after = tokens[pos + 1] if pos + 1 < len(tokens) else ""
        if len(token) >= 2 and "." not in token:
            h = None if doc_id is None else (doc_id * 7919 + pos * 10473) % 97
            out.append((doc_id, len(text), pos, token, at, end, end + 1 + len(after) if after else None, h))
        at = end + 1
    return out


def test_spans_of_slices_equal_plain_ones(monkeypatch):
    ids, texts = (pa.array(x, t) for x, t in zip(zip(*TEXTS, strict=True), (pa.int64(), pa.string()), strict=True))
    want = [row for doc_id, text in TEXTS for row in _plain(doc_id, text)]
    for size, rows in ((1, 3), (40, 50_000), (1 << 21, 50_000)):
        monkeypatch.setattr(X, "SLICE", size)
        monkeypatch.setattr(X, "ROWS", rows)
        batch = pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])
        got = [r for b in X._spans_of([batch.slice(0, 2), batch.slice(2)]) for r in b.to_pylist()]
        assert [(r["doc_id"], r["n"], r["pos"], r["token"], r["start"], r["end"], r["end2"], r["h"]) for r in got] == want
        text_of, seen = dict(TEXTS), {}
        for r in got:
            assert text_of[r["doc_id"]][r["start"] :].startswith(r["around"])
            before = seen.setdefault(r["doc_id"], dict.fromkeys(["gold", *X.ANNOTATORS], 0))
            assert {x: r[f"before_{x}"] for x in before} == before
            for x, takes in ({"gold": [X.GOLD]} | X.TAKEN).items():
                before[x] += 0 if r["h"] is None else sum(bool(take(lambda k, h=r["h"]: h % k)) for take in takes)


def test_annotations_shuffle_documents_once(spark, data):
    plan = X.annotations(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Join" not in plan


def test_annotations_stand_where_their_text_does(spark, data):
    rows = X.annotations(spark, data).join(X.documents(spark, data).select("document_id", "text"), "document_id")
    assert rows.where("span_text <> trim(BOTH ' \n\t' FROM substr(text, start + 1, end - start))").count() == 0
    assert rows.groupBy("document_id", "source").agg({"ordinal": "max", "*": "count"}).where("`max(ordinal)` <> `count(1)`").count() == 0


def test_spans_of_payloads_carry_no_texts(spark):
    docs = spark.createDataFrame([("d", "some gbm text", "some")], "document_id string, text string, title string")
    records = spark.createDataFrame([("d", json.dumps([{"mention": "gbm", "type": "disease"}, {"mention": "none", "type": "disease"}]))], "document_id string, payload string")
    df = payloads.flat_json_to_annotations(records, docs)
    assert [(r.start, r.end, r.text) for r in df.orderBy("ordinal").collect()] == [(5, 8, None), (None, None, None)]
    assert [(r.start, r.end) for r in harmonize.make_annotations(df, "text").orderBy("ordinal").collect()] == [(5, 8), (None, None)]


def test_only_columns_asked_for_are_built(spark, data):
    # the same rows, whatever else is left out
    for columns in (["document_id", "source"], ["document_id", "source", "ordinal", "start", "end", "entity_type"], ["document_id", "annotation_id", "source_rank"], ["document_id", "start", "canonical_id", "confidence"]):
        whole = X.annotations(spark, data).select(*columns)
        few = X.annotations(spark, data, columns=columns)
        assert few.columns == columns and few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty()
    sources = X.annotations(spark, data, columns=["document_id", "source"])._jdf.queryExecution().analyzed().toString()
    assert "span_text#" not in sources.split("MapInArrow")[1].split("\n")[0]
    text = X.gold_with_text(spark, data).drop("span_text")
    assert text.exceptAll(X.gold(spark, data)).isEmpty() and X.gold(spark, data).exceptAll(text).isEmpty()
