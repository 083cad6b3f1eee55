import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import mixing, toxicity, wordhash
from spanloom.llm.components import components
from spanloom.llm.decontaminate import contamination, drop_contaminated
from spanloom.llm.ngram_jaccard import keep_one_each, near_duplicate_components
from spanloom.llm.substring_dedup import dedup_substrings, remove_reference_spans
from spanloom.llm.suffix_automaton import SuffixAutomaton

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed, n=60, vocabulary=40):
    """Texts of few words, so that chance repeats abound, with copies, near copies and odd rows."""
    rnd = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"Wé{i}." for i in range(vocabulary)]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([1, 2, 5, 25, 60, 120]))) for _ in range(n)]
    passage = " ".join(rnd.choices(words, k=30))
    for i in range(n // 3):
        base = rnd.choice(texts).split()
        kind = i % 4
        if kind == 0:
            texts.append(" ".join(base))
        elif kind == 1 and base:
            base[rnd.randrange(len(base))] = "edit"
            texts.append(" ".join(base))
        elif kind == 2:
            texts.append(" \n".join([*base[:7], passage, *base[7:]]))
        else:
            texts.append(" ".join(base[: len(base) // 2]) + "\tx " + passage.upper())
    texts += ["", "   ", None, "again " * 70, "a b c d e " * 12, "x", "é\x0bé", "\x00\x01"]
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, f"s{(d or 0) % 4}" if d != 7 else None, 1) for d, t in rows], DOCS)


def test_words_and_hashes_agree_with_patterns():
    texts = [t for _, t in corpus(1)] + ["ÀB-c9 _x", "tab\tnl\nff\x0c"]
    for kind, pattern, fold in ((wordhash.PLAIN, brute.PLAIN, False), (wordhash.ALNUM_LOWER, brute.ALNUM, True)):
        known = {}
        for w in wordhash.tokenised(pa.array(texts), kind, chunk_bytes=200):
            h = w.hashes()
            for r in range(w.n_rows):
                t = texts[w.first_row + r]
                want = pattern.findall(brute.lower(t) if fold else t or "")
                at = range(w.row_word[r], w.row_word[r + 1])
                assert [brute.lower(w.text(i)) if fold else w.text(i) for i in at] == want
                for i, word in zip(at, want, strict=True):
                    assert known.setdefault(int(h[i]), word) == word
        assert len(set(known.values())) == len(known)


def test_winnowing_keeps_a_gram_of_every_shared_span():
    rnd = np.random.default_rng(3)
    span = rnd.integers(1, 1 << 60, 20).astype(np.uint64)
    for _ in range(50):
        texts = [np.concatenate([rnd.integers(1, 1 << 60, rnd.integers(0, 9)).astype(np.uint64), span, rnd.integers(1, 1 << 60, rnd.integers(0, 9)).astype(np.uint64)]) for _ in (0, 1)]
        a, b = (set(wordhash.winnow(t, np.zeros(len(t), int), 6, 20)[1].tolist()) for t in texts)
        assert a & b


def test_suffix_automaton_against_substrings():
    rnd = random.Random(5)
    for _ in range(60):
        seqs = [[rnd.randrange(3) for _ in range(rnd.randrange(12))] for _ in range(4)]
        automaton, seen = SuffixAutomaton(), set()
        for s in seqs:
            got = automaton.add(s)
            for e in range(len(s)):
                subs = [tuple(s[b : e + 1]) for b in range(e + 1)]
                assert got[e] == max((len(x) for x in subs if x in seen), default=0)
                seen.update(subs)
        probe = [rnd.randrange(3) for _ in range(15)]
        got = automaton.matching_statistics(probe)
        for e in range(len(probe)):
            assert got[e] == max((e + 1 - b for b in range(e + 1) if tuple(probe[b : e + 1]) in seen), default=0)


@pytest.mark.parametrize(("seed", "hot", "bytes_"), [(1, 2000, 8 << 20), (2, 1, 3000), (3, 3, 1500)])
def test_substring_dedup(spark, seed, hot, bytes_):
    rows = corpus(seed)
    rows += [(None, rows[4][1]), (5, rows[5][1]), (5, "other text of the same id"), (10**15, rows[6][1])]
    got = dedup_substrings(frame(spark, rows).withColumn("n_words", F.lit("clash")), hot=hot, bucket_bytes=bytes_).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute.substring_dedup(rows)


def test_substring_dedup_empty_and_carry(spark):
    assert dedup_substrings(frame(spark, [(1, "a")]).where("doc_id > 5")).count() == 0
    row = dedup_substrings(frame(spark, [(1, "a  b")]), carry=["source", "doc_id"]).first()
    assert (row.source, row.doc_id, row.kept_text) == ("s1", 1, "a b")


def test_ids_of_other_types_are_an_error(spark):
    docs = spark.createDataFrame([("a", "x y z")], "doc_id string, text string")
    for operator in (dedup_substrings, near_duplicate_components, keep_one_each):
        with pytest.raises(TypeError, match="whole number"):
            operator(docs)


def test_long_text(spark):
    words = [f"t{i}" for i in range(60_000)]
    text = " ".join(words + words[:30])
    row = dedup_substrings(frame(spark, [(1, text)])).first()
    assert (row.n_words, row.n_removed) == (60_030, 30)
    assert near_duplicate_components(frame(spark, [(1, text), (2, text + " more")])).where("component_id = 1").count() == 2


def test_remove_reference_spans(spark):
    words = [f"r{i}" for i in range(60)]
    reference = spark.createDataFrame([(" ".join(words[:40]),), (" ".join(words[30:]),), (None,)], "text string")
    docs = frame(spark, [(1, "x " + " ".join(words[:25]) + " y"), (2, " ".join(words[:19])), (3, None), (4, " ".join(words))])
    got = {r.doc_id: r for r in remove_reference_spans(docs, reference, shard_words=50).collect()}
    assert got[1].kept_text == "x y" and got[2].n_removed == 0 and got[3].n_words == 0 and got[4].kept_text == ""
    with pytest.raises(ValueError, match="more than"):
        remove_reference_spans(docs, reference, max_words=10)


@pytest.mark.parametrize("block_words", [1_000_000, 25])
def test_contamination(spark, block_words):
    rows = corpus(4)
    items = [(i, t) for i, t in rows if t and i % 7 == 0] + [(900, "edit"), (901, None), (902, "..."), (None, rows[3][1]), (903, rows[3][1]), (0, "w1 w2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [*rows, (None, "w1 w2 edit"), (3, rows[3][1])])
    got = contamination(docs.withColumn("n_hit", F.lit(1)), bench, block_words=block_words).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in got) == brute.contamination([(r.doc_id, r.text) for r in docs.collect()], items)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    clean = {r.doc_id for r in got if not (r.n_hit and 20 * r.n_hit >= r.n_words)}
    assert {r.doc_id for r in kept.collect()} == clean


def test_contamination_by_frequent_fingerprints_and_long_items(spark, monkeypatch):
    """One phrase in every item; an item of several blocks; items whose words no blank parts."""
    from spanloom.llm import decontaminate

    monkeypatch.setattr(decontaminate.BenchmarkIndex.__init__, "__defaults__", (2,))
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    phrase = " ".join(rnd.choices(words, k=16))
    items = [(i, f"{' '.join(rnd.choices(words, k=6))} {phrase} {' '.join(rnd.choices(words, k=6))}") for i in range(12)]
    items += [(50, ",".join(rnd.choices(words, k=200))), (51, "x,y;z")]
    rows = [(i, f"{' '.join(rnd.choices(words, k=9))} {rnd.choice([phrase, 'none'])} {rnd.choice(items)[1]}") for i in range(30)] + [(90, items[12][1].upper()), (91, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (1_000_000, 60):
        got = contamination(frame(spark, rows), bench, block_words=block_words).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in got) == brute.contamination(rows, items)
    words = [len(x.words) for x in decontaminate._blocks(bench, "item_id", "text", 13, 5, 60)]
    assert max(words) <= 60 and len(words) > 8


def test_contamination_of_long_texts(spark):
    text = " ".join(f"t{i}" for i in range(60_000))
    bench = spark.createDataFrame([(1, "t5 t6"), (2, " ".join(f"t{i}" for i in range(30_000, 30_020)))], "item_id long, text string")
    row = contamination(frame(spark, [(1, text)]), bench).first()
    assert (row.n_words, row.n_hit, row.item_ids) == (60_000, 22, ["1", "2"])


def test_contamination_without_items_or_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, "One two"), (2, None)])
    assert {(r.doc_id, r.n_words, r.n_hit) for r in contamination(docs, bench).collect()} == {(1, 2, 0), (2, 0, 0)}
    assert contamination(docs.where("doc_id = 9"), docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def near_copies(seed):
    """Chains of edits: neighbours link, ends do not; and a hot line in unlike texts."""
    rnd = random.Random(seed)
    rows, line = [], "the same line stands in very many of the texts here"
    for g in range(6):
        text = [f"g{g}_{i}" for i in range(rnd.choice([40, 80]))]
        for k in range(12):
            rows.append((len(rows), " ".join(text)))
            if k % 3:
                text[rnd.randrange(len(text))] = f"e{g}_{k}"
    rows += [(len(rows) + i, f"{line} {i} {i * 7} z{i}") for i in range(40)]
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "one", "one", "one two", "ONE Two", line, line])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_components(spark, seed):
    rows = near_copies(seed) + [(5000 + i, t) for i, t in corpus(seed)]
    docs = frame(spark, rows).withColumn("n_shingles", F.lit("clash"))
    got = near_duplicate_components(docs, shard_bytes=500, fragments=3)
    want = brute.jaccard_components(rows)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert {r.doc_id: r.n_shingles for r in got.collect()} == {d: len(brute.shingles(t)) for d, t in rows}
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, c in want.items() if c == d}


def test_near_duplicates_odd_ids(spark):
    rows = [(None, "a b c d"), (1, "a b c d"), (1, "q r s t u"), (2, "q r s t u"), (1, "a b c d")]
    got = near_duplicate_components(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (1, 1), (1, 1), (1, 1), (2, 1)]
    assert near_duplicate_components(frame(spark, rows).where("doc_id = 9")).count() == 0
    assert sorted((r.doc_id or 0, r.text[0]) for r in keep_one_each(frame(spark, rows)).collect()) in ([(0, "a"), (1, "a")], [(0, "a"), (1, "q")])


def test_signatures_differ_no_more_than_sets():
    from spanloom.llm.ngram_jaccard import parities

    rnd = np.random.default_rng(2)
    for n in (1, 30, 700, 5000):
        x = np.unique(rnd.integers(1, 1 << 60, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[: n * 9 // 10], rnd.integers(1, 1 << 60, n // 7).astype(np.uint64))))
        differ = sum(bin(int(a) & (1 << 64) - 1).count("1") for a in (parities(x) ^ parities(y)))
        assert differ <= len(np.setxor1d(x, y)) and (n > 100 or differ >= len(np.setxor1d(x, y)) // 2) and not parities(x[:0]).any()


def test_one_frequent_ngram_in_unlike_texts(spark, monkeypatch):
    """Texts that share their rarest n-grams but are no near copies: every pair of the group is judged, in cells."""
    from spanloom.llm import ngram_jaccard

    monkeypatch.setattr(ngram_jaccard, "CELL", 10)
    rnd = random.Random(3)
    common = [f"{a} {b} {c}" for a in "pqr" for b in "pqr" for c in "pqr"]
    texts = {" ".join(rnd.choices("pqr", k=14)) for _ in range(150)} | set(common)
    rows = list(enumerate(sorted(texts)))
    got = {r.doc_id: r.component_id for r in near_duplicate_components(frame(spark, rows)).collect()}
    assert got == brute.jaccard_components(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_mixing_targets_and_copies(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randrange(400 if i % 4 else 40)) for i in range(800)] + [(7, None), (900, "")]
    docs = frame(spark, rows).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs, keep=["source"]).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        sizes[r._k0] += r._size
        taken[r._k0] += r._copies * r._size
        targets[r._k0] = r._target
        assert r._copies <= 2
    want = brute.mix_targets(dict(sizes))
    assert targets.keys() == want.keys() and all(abs(targets[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)
    assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] + 100 for s in want)
    assert sorted(map(repr, mixing.mix(docs.repartition(7), keep=["source"], broadcast_sources=0).collect())) == sorted(map(repr, got))
    assert mixing.emit(docs).columns == docs.columns and mixing.emit(docs).count() == sum(r._copies for r in got)
    assert mixing.emit(docs.where("doc_id = -1")).count() == 0


def test_toxicity_generalises(spark):
    rnd = random.Random(8)
    words, bad = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"], ["loxkra", "loxkrum", "zunfret"]
    rows, labels = [], []
    for i in range(700):
        text = rnd.choices(words, k=rnd.choice([5, 40, 300]))
        if i % 5 == 0:
            text[rnd.randrange(len(text))] = rnd.choice(bad).title()
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(i % 5 == 0)))
    rows += [(700, None), (701, ""), (None, "loxkra")]
    labels += [(None, 0, 1), (3, 0, None), (0, 0, 0), (9999, 1, 1)]
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, learn_from=~toxicity.held_out())
    got = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("score", F.lit("clash")), model).collect()}
    out = {r.doc_id for r in docs.where(toxicity.held_out()).collect()} & set(range(700))
    assert len(out) > 80 and sum((got[i] >= 0.5) == (i % 5 == 0) for i in out) / len(out) >= 0.97
    assert got[700] == got[701] and 0 <= got[700] < 0.5 <= got[None] <= 1
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, s in got.items() if s < 0.5}
    nothing = toxicity.fit(docs, labels.where("toxic = 0"), learn_from=~toxicity.held_out())
    assert all(r.score == pytest.approx(1 / (1 + np.exp(-nothing.intercept))) for r in toxicity.score(docs, nothing).collect())


def test_toxicity_uses_every_telling_ngram(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    plain, marks = [word() for _ in range(300)], [word() for _ in range(300)]
    rows = [(i, " ".join(rnd.sample(plain, 8) + (rnd.sample(marks, 10) if i % 2 else []))) for i in range(1000)]
    docs, labels = frame(spark, rows), spark.createDataFrame([(i, 0, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, learn_from=~toxicity.held_out())
    assert len(model.weights) > 2048
    out = {r.doc_id for r in docs.where(toxicity.held_out()).collect()}
    wrong = [r.doc_id for r in toxicity.score(docs, model).collect() if r.doc_id in out and (r.score >= 0.5) != (r.doc_id % 2 == 1)]
    assert len(wrong) <= len(out) // 50


def test_toxicity_against_plain_python(spark):
    """Ratios from presence counts, weights at the minimum of the penalised loss, scores from both."""
    import math

    rnd = random.Random(9)
    words = ["alpha", "Beta", "gamma", "delta", "omega", "ZETA"]
    rows = [(i, " ".join(rnd.choices(words, k=4) + (["vexing brute"] if i % 3 == 0 else []))) for i in range(120)]
    docs, labels = frame(spark, rows), spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, learn_from=F.lit(True))

    def features(text):
        data = brute.lower(text).encode()
        return {(int.from_bytes(data[p : p + n], "little") + n) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - toxicity.BITS for n in toxicity.ORDERS for p in range(len(data) - n + 1)}

    texts = {t: int(i % 3 == 0) for i, t in rows}
    found = {t: features(t) for t in texts}
    n = Counter(texts.values())
    counts = [Counter(f for t, y in texts.items() if y == c for f in found[t]) for c in (0, 1)]
    ratio = {f: math.log((counts[1][f] + 1) / (n[1] + 2)) - math.log((counts[0][f] + 1) / (n[0] + 2)) for f in counts[0] | counts[1]}
    kept = {f for f in ratio if counts[0][f] + counts[1][f] >= 3 and abs(ratio[f]) / math.sqrt(1 / (counts[1][f] + 1) + 1 / (counts[0][f] + 1)) > 2}
    assert set(np.flatnonzero(model.slot).tolist()) == kept
    weight = {f: model.weights[model.slot[f] - 1] for f in kept}
    p = {t: 1 / (1 + math.exp(-(model.intercept + sum(weight[f] for f in found[t] & kept)))) for t in texts}
    for f in kept:
        slope = ratio[f] * sum(p[t] - y for t, y in texts.items() if f in found[t]) + 0.3 * weight[f] / ratio[f]
        assert abs(slope) <= 2e-5 * len(texts)
    assert abs(sum(p[t] - y for t, y in texts.items())) <= 2e-5 * len(texts)
    assert all(r.score == pytest.approx(p[dict(rows)[r.doc_id]], abs=1e-6) for r in toxicity.score(docs, model).collect())


def test_toxicity_of_odd_tables(spark):
    docs, labels = frame(spark, [(1, "a very bad text"), (1, "a very bad text"), (2, None)]), spark.createDataFrame([(1, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    nothing = toxicity.fit(docs.where("doc_id > 5"), labels, learn_from=F.lit(True))
    assert toxicity.score(docs.where("doc_id > 5"), nothing).count() == 0 and toxicity.score(docs, nothing).where("score = 0.5").count() == 3
    none = toxicity.fit(docs, labels.where("doc_id > 5"), learn_from=F.lit(True))
    long = frame(spark, [(1, "word " * 400_000)])
    assert toxicity.score(long, none).first().score == 0.5 and toxicity.drop_toxic(docs, none, threshold=0.6).count() == 3


def test_leader_of_a_group_is_the_home(spark):
    from spanloom.llm.ngram_jaccard import _pair

    one = lambda x, t: np.array(x, t).tobytes()
    columns = [one([7] * 3, np.uint64), one([9, 1, 2], np.int64), one([90, 10, 20], np.int64), one([50] * 3, np.uint32), one([0] * 3, np.uint32), one([5, 1, 1], np.uint32)]
    table = pa.table({"shard": pa.array([0], pa.int32())} | {c: [x] for c, x in zip(("tokens", "ids", "sets", "sizes", "places", "copies"), columns, strict=True)})
    pairs = {(r["a"], r["b"]) for r in _pair(90, 100)(table).to_pylist() if r["kind"] == 0}
    assert pairs == {(9, 1), (9, 2)}
