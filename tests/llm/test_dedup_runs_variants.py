"""Suffix-array dedup, spelling variants and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import byte_dedup, spelling
from spanloom.llm.byte_dedup import dedup_bytes, pack, unpack
from spanloom.llm.periodic_runs import find_runs, periodic_runs
from spanloom.llm.queries import op13_periodic_runs, with_periodic_tails
from spanloom.llm.spelling import count_words, group_variants, misspelt, near_words
from spanloom.llm.suffix_levels import SuffixLevels
from spanloom.llm.wordhash import U64

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- suffix-array dedup
def plain_byte_dedup(rows, n=50):
    first, out = {}, []
    for d, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            first.setdefault(b[i : i + n], -1 if d is None else d)
    for d, t in rows:
        b, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < (-1 if d is None else d):
                gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return Counter(out)


def texts(seed, n=50):
    """Documents of shared passages, copies with edits, repeats inside one document, and odd rows."""
    r = random.Random(seed)
    word = lambda: r.choice(["aé", "stone", "river", "ß", "of", "the", "mill", "x" * r.randint(1, 12), "zero\0"])
    passage = lambda k: " ".join(word() for _ in range(k))
    shared = [passage(r.randint(5, 60)) for _ in range(6)]
    rows = [(i, " ".join([passage(r.randint(0, 20)), r.choice(shared), passage(r.randint(0, 9)), r.choice(shared)])) for i in range(n)]
    for i in range(n):
        t = r.choice(rows)[1]
        cut = r.randint(0, len(t))
        rows.append((r.choice([n + i, i]), t[:cut] + r.choice(["", "!", "#" * 60]) + t[cut + r.randint(0, 2) :]))
    return rows + [(None, shared[0]), (None, shared[0]), (900, None), (901, ""), (902, "a" * 49), (903, "a" * 300), (904, "a" * 50), (905, shared[1] * 40)]


@pytest.mark.parametrize("seed, hot, bucket, batch", [(1, 2000, 1 << 20, 1 << 17), (2, 3, 2000, 40), (3, 2000, 4000, 300), (4, 0, 1500, 1 << 17)])
def test_byte_dedup(spark, seed, hot, bucket, batch):
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedup_bytes(df, hot=hot, bucket_bytes=bucket, batch_windows=batch).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in got) == plain_byte_dedup(rows)


def test_byte_dedup_of_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(byte_dedup, "CHUNK_BYTES", 700)
    rows = texts(5, 20)
    rows += [(50 + i, " ".join(t for _, t in rows[i : i + 9] if t)) for i in range(6)]
    # the tasks run in other processes, so the small chunks are seen in the function's own module only
    docs = {"text": [t for _, t in rows]}
    import pyarrow as pa

    parts = list(byte_dedup._chunks(pa.chunked_array([pa.array(docs["text"], pa.string())]), 50))
    windows = Counter()
    for data, edges, row, _ in parts:
        for i in range(len(edges) - 1):
            piece = bytes(data[edges[i] : edges[i + 1]])
            windows.update((row + i, piece[s : s + 50]) for s in range(len(piece) - 49))
    whole = Counter((i, (t or "").encode()[s : s + 50]) for i, t in enumerate(docs["text"]) for s in range(len((t or "").encode()) - 49))
    assert windows == whole and max(len(p[0]) for p in parts) <= 749


def test_byte_dedup_empty_carry_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_bytes(df).collect() == []
    df = spark.createDataFrame([(1, "q" * 60, "x", 7), (2, "q" * 60, None, 8)], "doc_id long, text string, bucket string, n_bytes long")
    got = dedup_bytes(df, carry=["doc_id", "bucket"]).orderBy("doc_id").collect()
    assert [(r.doc_id, r.bucket, r.n_bytes, r.n_removed, r.n_spans) for r in got] == [(1, "x", 60, 0, 0), (2, None, 60, 60, 1)]
    with pytest.raises(TypeError):
        dedup_bytes(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_suffix_levels_against_a_dictionary():
    r = random.Random(7)
    index, first = SuffixLevels(6), {}
    for doc in range(80):
        text = np.frombuffer("".join(r.choice("ab\0") for _ in range(r.randint(6, 60))).encode(), np.uint8)
        at = np.arange(len(text) - 5)
        keys = [bytes(text[i : i + 6]) for i in at]
        for key in keys:
            first.setdefault(key, doc)
        assert index.add(text, at, np.full(len(at), doc)).tolist() == [first[key] for key in keys]
    sizes = [len(level) for level in index.levels]
    assert sum(sizes) == len(first) and all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


def test_packed_numbers():
    for x in ([], [5], [-(2**63), 0, 2**62, 2**62], list(range(0, 5000, 7))):
        assert unpack(pack(np.array(x, np.int64))).tolist() == x


# ---------------------------------------------------------------- periodic runs
def plain_runs(w, least=12):
    """By definition: every maximal stretch of each lag, of equal stretches the smallest lag."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_texts(seed, n=120):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            unit = [r.choice("abcdxyz") for _ in range(r.choice([1, 2, 3, 5, 8, 13, 21, 40]))]
            w += (unit * 9)[: r.randint(1, 4 * len(unit))] + [r.choice("ab") for _ in range(r.randint(0, 5))]
        out.append(" ".join(w))
    return out + [None, "", " \t", "a " * 11, "a " * 12, "a " * 4000, "a b " * 6, ("a " * 50 + "b ") * 40, " ".join("ab"[bin(i).count("1") % 2] for i in range(4096))]


def test_periodic_runs(spark):
    rows = [(i % 50 if i else None, t) for i, t in enumerate(run_texts(3))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = Counter()
    for d, t in rows:
        w = PLAIN.findall(t or "")
        runs = plain_runs(w)
        expected[(d, tuple(runs), plain_collapsed(w, runs))] += 1
    got = periodic_runs(df).collect()
    assert Counter((x.doc_id, tuple((r.start, r.length, r.period) for r in x.runs), x.collapsed) for x in got) == expected
    assert sum(len(x.runs) for x in got) > 100


def test_runs_of_a_long_text_take_little_work():
    """Every word equal: each scale compares each word with two places, and one run is left."""
    row, start, length, period = find_runs(np.full(300_000, 7, U64), np.array([0, 300_000]))
    assert (row.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [300_000], [1])
    words = np.tile(np.random.default_rng(1).integers(1, 1 << 60, 70_001).astype(U64), 3)
    assert [x.tolist() for x in find_runs(words, np.array([0, len(words)]))[1:]] == [[0], [210_003], [70_001]]


def test_periodic_runs_empty_and_clashing_columns(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "a " * 12, "x")], "doc_id long, text string, runs string")
    got = periodic_runs(df.withColumnRenamed("runs", "c0"), carry=["c0", "doc_id"]).first()
    assert (got.c0, got.doc_id, len(got.runs), got.collapsed) == ("x", 1, 1, "a")


def test_periodic_runs_query_against_plain_python(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(run_texts(11, 150))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected, changed = set(), 0
    for d, t in rows:
        w, h = PLAIN.findall(t or ""), zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, changed = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)], changed + 1
        runs = plain_runs(w)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        figures = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        expected.add((d, len(runs), *figures, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapsed(w, runs))))
    assert changed > 5
    assert {tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()} == expected
    assert with_periodic_tails(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ---------------------------------------------------------------- spelling variants
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, factor=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    root = {}
    for w in counts:
        at = w
        while form[at]:
            at = form[at]
        root[w] = at
    return {(w, form[w], root[w], counts[w], len(near[w]), counts.get(form[w])) for w in counts}


@pytest.mark.parametrize("seed, tile_rows, task_rows", [(1, 2048, 200_000), (2, 3, 50), (3, 1, 5)])
def test_spelling_variants(spark, seed, tile_rows, task_rows):
    r = random.Random(seed)
    counts = {"".join(r.choice("abé") for _ in range(r.randint(1, 7))): r.choice([1, 5, 25, 125, 625, 3125, r.randint(1, 99)]) for _ in range(160)}
    counts |= {"x" * 300: 5, "x" * 301: 25, "x" * 150 + "y" + "x" * 150: 125, "𝔘nicode": 5, "Unicode": 25}
    rows = [(w, n, "other") for w, n in counts.items()] + [(None, 5, ""), ("", 7, ""), ("null", None, "")]
    rows[3:4] = [(rows[3][0], rows[3][1] - 1, ""), (rows[3][0], 1, "")] if rows[3][1] > 1 else rows[3:4]
    df = spark.createDataFrame(rows, "word string, n long, near string").repartition(3)
    got = group_variants(df, tile_rows=tile_rows, task_rows=task_rows).collect()
    assert len(got) == len(counts) and {tuple(x) for x in got} == plain_variants(counts)


def test_dense_tiles_of_one_key(spark, monkeypatch):
    """A key of many words is cut into tiles; every pair is found once in either direction."""
    words = [f"prefix{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    pairs = [(x.word, x.near) for x in near_words(df, tile_rows=32).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}
    monkeypatch.setattr(spelling, "BLOCK", 3)
    i, j = spelling.tile_pairs(words, np.zeros(400, np.int64), np.zeros(400, np.int64), np.zeros(400, np.int64), 4, 8, False)
    assert {(words[a], words[b]) for a, b in zip(i, j, strict=True)} == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_word_counts_and_misspellings(spark):
    r = random.Random(4)
    base = ["Straße", "Forêts", "running", "Übergang", "letters", "short", "Kanal×ab", "mixed-case", "longer" * 40]
    rows = [(i % 300 if i else None, " ".join(r.choice(base) for _ in range(40))) for i in range(400)] + [(7, None), (8, ""), (9, "12 34")]
    expected = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            expected[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 6 and n >= 5}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).repartition(4)
    got = {x.word: x.n for x in count_words(df, change=lambda w: misspelt("doc_id", w)).collect()}
    assert got == expected and len(got) > len(base) - 2
    assert group_variants(count_words(df.limit(0))).collect() == []
