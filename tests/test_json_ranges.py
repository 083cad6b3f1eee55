"""JSON lists cut at byte ranges, and payloads cut into pieces."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.sources import files, payloads, records
from spanloom.sources.json_ranges import State, cut_elements, read_json_elements, split_payloads, unparsable

ODD = ['"', "\\", '\\"', "}{][", "\\\\", "é𝔘", "documents", '"documents": [{', "\n"]


def record(r):
    text = lambda: "".join(r.choice([*ODD, "word ", "x"]) for _ in range(r.randint(0, 12)))
    return {"document_id": r.choice([None, text() + "d"]), "title": text(), "abstract": text(), "metadata": {text(): text()}, "deep": [{"a": [text(), {"b": {}}]}]}


def test_elements_under_any_cut():
    r = random.Random(1)
    for form in range(40):
        rows = [record(r) for _ in range(r.randint(0, 6))]
        body = json.dumps(rows, ensure_ascii=bool(form % 2), indent=r.choice([None, 1]))
        whole = body if form % 3 == 0 else '{"before": {"documents": [{"no": 1}], "x": {}}, "documents" : %s, "after": [{"no": 2}], "z": {"y": {"no": 3}}}' % body
        wanted = None if form % 3 == 0 else frozenset(["documents"])
        data = np.frombuffer(whole.encode(), np.uint8)
        found = [json.loads(data[a:b].tobytes()) for a, b in cut_elements(data, State(), wanted, None)]
        assert found == rows


@pytest.mark.parametrize("size", [29, 300, 1 << 20])
def test_files_in_ranges(spark, tmp_path, size):
    r = random.Random(size)
    rows = {}
    for name, form in (("a.json", "list"), ("b.json", "object"), ("c.json", "list")):
        rows[name] = [record(r) for _ in range(0 if name == "c.json" else 9 if size > 29 else 2)]
        body = json.dumps(rows[name], ensure_ascii=False)
        body = body if form == "list" else '{"note": ["documents", {"k": "\\\\"}], "documents": %s, "more": [{"no": 1}], "end": {"no": {}}}' % body
        (tmp_path / name).write_bytes((b"\xef\xbb\xbf" if name == "a.json" else b"  ") + body.encode())
    got = read_json_elements(spark, str(tmp_path), range_bytes=size).collect()
    for name, want in rows.items():
        own = sorted((x["index"], x["value"]) for x in got if x.path.endswith(name))
        assert [i for i, _ in own] == list(range(len(want))) and [json.loads(v) for _, v in own] == want
    docs = files.read_corpus_json(spark, f"file://{tmp_path}", range_bytes=size).collect()
    assert len(docs) == sum(map(len, rows.values())) and {d.document_id for d in docs if d.document_id.startswith("CORPUS")} == {f"CORPUS:{i}" for x in rows.values() for i, y in enumerate(x) if y["document_id"] is None}


def test_one_long_list_is_many_tasks(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"document_id": f"d{i}", "title": "t" * 500} for i in range(4000)]))
    df = read_json_elements(spark, str(tmp_path / "x.json"), range_bytes=1 << 16)
    assert df.rdd.getNumPartitions() == 33 and df.select(F.max("index")).first()[0] == 3999


def test_large_payloads_come_in_pieces(spark, monkeypatch):
    from spanloom.sources import json_ranges

    monkeypatch.setattr(json_ranges, "LARGE_BYTES", 200)
    docs = [{"id": str(i), "text": "}" * i} for i in range(30)]
    rows = [(1, json.dumps({"x": 1, "PubTator3": docs})), (2, json.dumps({"documents": docs[:2]})), (3, json.dumps(docs)), (4, "{bad"), (5, None), (6, '{"a": "%s"}' % ("z" * 300))]
    df = spark.createDataFrame(rows, "batch int, payload string")
    pieces = split_payloads(df, large_bytes=200)
    assert pieces.where("batch = 6").count() == 1 and {x.batch for x in pieces.collect()} == {1, 2, 3, 4, 5, 6}
    got = records.merge_payload_batches(df).where("batch < 3").collect()
    assert sorted((x.batch, x.position, json.loads(x.document)["id"]) for x in got) == [(1, i, str(i)) for i in range(30)] + [(2, i, str(i)) for i in range(2)]
    assert sorted((x.batch, x.status, x.reason) for x in unparsable(df).collect()) == [(4, "failed", "no valid JSON"), (5, "failed", "no payload")]
    spans = spark.createDataFrame([("d", json.dumps([{"text": f"w{i}", "label": "gene", "start": i, "end": i + 2} for i in range(40)]))], "document_id string, payload string")
    documents = spark.createDataFrame([("d", "w" * 60, "")], "document_id string, text string, title string")
    assert [x.ordinal for x in payloads.span_records_to_annotations(spans, documents, "x").orderBy("ordinal").collect()] == list(range(1, 41))
