import hashlib
import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanloom.llm import chat, html_extract, language_id, lm_scoring, queries, topk, toxicity

from . import brute

ENGLISH, FRENCH, GREEK = "the of and that with from this have which".split(), "les des une avec pour dans elle être".split(), "και του της από είναι στην".split()


def test_language_spans_and_predictions(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(240):
        words = (ENGLISH, FRENCH, GREEK)[i % 3]
        rows.append((i, " ".join(rnd.choices(words, k=12)), ("en", "fr", "el")[i % 3]))
    rows += [(900, None, "en"), (901, "123 !!", "en"), (902, "", None), (903, " ".join(ENGLISH * 3 + GREEK * 4 + ENGLISH * 3), None), (904, "the", None), (None, "les des", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, learn_from=~language_id.held_out())
    got = {r.doc_id: r for r in language_id.identify(docs.withColumn("score", F.lit("clash")), model).collect()}
    assert model.languages == ["el", "en", "fr"]
    assert all(got[d].lang_pred == lang for d, _, lang in rows[:240])
    assert [got[d].lang_pred for d in (900, 901, 902)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert [s.lang for s in got[903].lang_spans] == ["en", "el", "en"] and got[903].lang_spans[1].start == 27
    assert language_id.identify(docs, language_id.fit(docs.where("lang = 'xx'"), learn_from=F.lit(True))).where("lang_pred <> 'und'").count() == 0


def test_language_of_texts_without_letters_and_of_few_texts(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(ENGLISH, k=12)), "en") for i in range(300)] + [(1000 + i, FRENCH[i % 3] + " les des", "fr") for i in range(3000)]
    odd = ["£ 100", "«»", "°", "· ·", "٣٤٥", "123", "", None, "—", "€5", "½", "\u0301", "😀"]
    rows += [(9000 + i, t, None) for i, t in enumerate(odd)] + [(9100, "ª", None), (9101, "ა", None), (9102, "𐍈", None), (9103, "1 x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, learn_from=F.lit(True), sample_rows=20)
    assert model.languages == ["en", "fr"]  # three texts, each very often, are three texts
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert all(got[9000 + i] == ("und", 0.0) for i in range(len(odd))), got
    assert all(got[d][0] in ("en", "fr") and got[d][1] == 1 for d in (9100, 9101, 9102, 9103))
    assert language_id.identify(docs.where("doc_id < 0"), model).count() == 0
    long = spark.createDataFrame([(1, " ".join(ENGLISH * 20_000))], "doc_id long, text string")
    assert language_id.identify(long, model).first().lang_pred == "en"


def test_language_predictions_against_plain_python(spark):
    """Word scores, Viterbi and votes, text by text, whatever the batches."""
    rnd = random.Random(6)
    words = ENGLISH + FRENCH + GREEK + ["12", "q", "é"]
    train = [(i, " ".join(rnd.choices((ENGLISH, FRENCH, GREEK)[i % 3], k=6)), ("en", "fr", "el")[i % 3]) for i in range(30)]
    asks = [(100 + i, rnd.choice(["", " ", "-"]).join(rnd.choice([" ", ", "]) + x for x in rnd.choices(words, k=rnd.randrange(1, 9)))) for i in range(60)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), learn_from=F.lit(True))
    bits = language_id.BITS

    def grams(text):
        data = b" " + bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in brute.lower(text).encode()) + b" "
        for p in range(len(data) - 1):
            for n in language_id.ORDERS:
                if p + n <= len(data):
                    yield p, (int.from_bytes(data[p : p + n], "little") + (n << 40)) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - bits

    langs = ["el", "en", "fr"]
    counts = {x: Counter(g for _, t, lang in {(0, t, lang) for _, t, lang in train} if lang == x for _, g in grams(t)) for x in langs}
    raw = {g: [math.log(counts[x][g] + 0.5) - math.log(counts[x].total() + 0.5 * 2**bits) for x in langs] for c in counts.values() for g in c}
    raw_none = [math.log(0.5) - math.log(counts[x].total() + 0.5 * 2**bits) for x in langs]
    centred = lambda v: [y - sum(v) / 3 for y in v]
    greek = lambda w: any("\u0370" <= c <= "\u03ff" for c in w)
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(asks, "doc_id long, text string").repartition(7), model).collect()}
    for d, text in asks:
        data, scores, weights = brute.lower(text).encode(), [], []
        values = {}
        for p, g in grams(text):
            values[p] = [a + b for a, b in zip(values.get(p, [0] * 3), centred(raw.get(g, raw_none)), strict=True)]
        for m in brute.ALNUM.finditer(brute.lower(text)):
            a, b = len(brute.lower(text)[: m.start()].encode()), len(brute.lower(text)[: m.end()].encode())
            s = [sum(values[p][k] for p in range(a, b + 1)) for k in range(3)]
            has = any(c.isalpha() for c in m[0])
            allowed = [True, False, False] if greek(m[0]) else [False, True, True]
            scores.append([x - (0 if ok else 1e4) for x, ok in zip(s, allowed, strict=True)] if has else [0, 0, 0])
            weights.append(b - a if has else 0)
        assert len(data) >= sum(weights)
        best = [(v, [k]) for k, v in enumerate(scores[0])] if scores else []
        for s in scores[1:]:
            best = [max(((v - (0 if p[-1] == k else language_id.PENALTY) + s[k], [*p, k]) for v, p in best), key=lambda x: x[0]) for k in range(3)]
        votes = Counter()
        for k, n in zip(max(best, key=lambda x: x[0])[1] if best else [], weights, strict=True):
            votes[k] += n
        if not votes.total():
            assert got[d].lang_pred == "und"
            continue
        top = max(range(3), key=lambda k: (votes[k], -k))
        assert (got[d].lang_pred, round(got[d].score, 6)) == (langs[top], round(votes[top] / votes.total(), 6)), text


def test_viterbi_against_all_paths():
    from itertools import product

    rnd = np.random.default_rng(0)
    sizes = [0, 1, 5, 3, 5]
    cut = np.concatenate(([0], np.cumsum(sizes)))
    scores = rnd.normal(size=(cut[-1], 3)).astype(np.float32)
    path = language_id.viterbi(scores, cut, 0.7)
    value = lambda s, p: sum(s[i][c] for i, c in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:], strict=False))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            assert value(scores[a:b], path[a:b].tolist()) == pytest.approx(max(value(scores[a:b], p) for p in product(range(3), repeat=b - a)), abs=1e-5)


TEXT = "This is a sentence of the article, which is long enough to be told from what stands around it. " * 2 + "So it ends."
SAID = "I read all of this twice and I must say that I do not agree with any of it, however well it is written."
PAGES = {
    "article": ("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article><h1>Big &amp; small</h1><p>First  para<br>goes on.<p>Second one.</article><footer>&copy; us</footer>", "Big & small\n\nFirst para goes on.\n\nSecond one."),
    "classes": ('<div id="header"><h1>Site name</h1></div><div class="sidebar"><p>Popular posts of the week and more words to fill it up</p></div><div class="post-content"><p>The body of the text is here, it is long enough.</p><ul><li>one<li>two</ul></div><div class="comments"><p>bob: I do like this text very much indeed</p></div><div class="cookie-notice">We use cookies</div>', "The body of the text is here, it is long enough.\n\none\n\ntwo"),
    "forms": ("<main><p>Text before.</p><form><label>Mail</label><input><button>Send</button></form><script>var a='<p>x</p>';</script><style>p{}</style><!-- <p>gone</p> --><p>Text after.</p></main>", "Text before.\n\nText after."),
    "entities": ("<article><p>a&lt;b &#233;&#x41; &unknown; &am</p></article>", "a<b éA &unknown; &am"),
    "wrapper state": ('<main class="has-sidebar"><h1>Title</h1><p>Text of the article, which is long enough.</p></main>', "Title\n\nText of the article, which is long enough."),
    "wrapper negated": ('<div class="no-sidebar"><article><p>Text of the article.</p></article></div>', "Text of the article."),
    "related topic": ('<article class="post related-topic"><p>Text of the article.</p></article>', "Text of the article."),
    "ad free": ('<div class="ad-free"><article><p>Text of the article.</p></article></div>', "Text of the article."),
    "page form": ('<form id="aspnetForm"><nav><a href=x>Home</a></nav><article><p>Text of the article.</p></article><footer>us</footer></form>', "Text of the article."),
    "comments": ('<article><p>The article.</p><section class="comments-area"><article class="comment"><p>I like it.</p></article></section></article><aside><article><p>Another one.</p></article></aside>', "The article."),
    "comments inside": (f"<article><h1>T</h1><p>{TEXT}</p><p>{TEXT}</p><section class='comments'><h2>2 comments</h2><p>{SAID}</p><div class='body'><p class='text'>{SAID}</p></div></section></article>", f"T\n\n{TEXT}\n\n{TEXT}"),
    "advert inside": (f"<article><p>{TEXT}</p><div class='ad'><p>{SAID}</p><p>Buy one now, they are cheap and good.</p></div><p>{TEXT}</p></article>", f"{TEXT}\n\n{TEXT}"),
    "newsletter inside": (f"<main><h1>T</h1><p>{TEXT}</p><div class='newsletter-box'><h3>Stay tuned</h3><p>{SAID}</p></div><p>{TEXT}</p></main>", f"T\n\n{TEXT}\n\n{TEXT}"),
    "related inside": (f"<article><p>{TEXT}</p><div class='related'><ul><li>{SAID}</li><li>More of it stands here.</li></ul></div></article>", TEXT),
    "discussion after": (f"<article><p>{TEXT}</p></article><div class='discussion'><p>{SAID}</p></div>", TEXT),
    "notice before": (f"<p>We use cookies to make this site better for all of its readers.</p><article><p>{TEXT}</p></article>", TEXT),
    "mixed class": (f"<div class='post-with-sidebar'><h1>T</h1><p>{TEXT}</p><p>{TEXT}</p></div>", f"T\n\n{TEXT}\n\n{TEXT}"),
    "wrapper of a bad name": (f"<div class='page-sidebar'><p>{TEXT}</p><p>{TEXT}</p></div>", f"{TEXT}\n\n{TEXT}"),
    "form around content": (f"<form id='aspnetForm'><div class='menu'><a href=x>Home</a></div><div class='content'><p>{TEXT}</p></div></form>", TEXT),
    "entry header": (f"<article><header class='entry-header'><h1>The title of it</h1></header><p>{TEXT}</p><footer class='entry-footer'>Filed under x</footer></article>", f"The title of it\n\n{TEXT}"),
    "comment form": (f"<article><p>{TEXT}</p></article><form class='comment-form'><p>Leave a reply here, it will be read.</p></form>", TEXT),
    "empty": ("", ""), "null": (None, ""), "boilerplate only": ("<nav><ul><li><a href=a>A</a></li></ul></nav>", ""),
}


def test_html_extraction(spark):
    rows = [(i, name, page) for i, (name, (page, _)) in enumerate(PAGES.items())]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.url: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    assert got == {name: (want, len(want)) for name, (_, want) in PAGES.items()}
    assert html_extract.extract(pages.where("page_id < 0")).count() == 0


def test_html_extraction_of_all_test_pages(spark, data):
    """The article element is the truth of these pages: h1 and p blocks, decoded and joined."""
    import html
    import re

    for r in html_extract.extract(spark.read.parquet(f"{data}/pages.parquet")).join(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1])
        blocks = (" ".join(html.unescape(x.replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_html_of_many_blocks_and_deep_nesting():
    began = time.perf_counter()
    page = "<body>" + "".join(f"<div><p>Some sentence of number {i} here.</p></div><div>short</div>" for i in range(50_000)) + "</body>"
    assert html_extract.main_text(page).count("Some sentence") == 50_000
    assert html_extract.main_text("<div>" * 20_000 + "<p>A sentence at the bottom of all the boxes.</p>" + "</div>" * 20_000 + "</b>" * 20_000) == "A sentence at the bottom of all the boxes."
    rnd = random.Random(3)
    n = 20_000
    a, b = [rnd.random() for _ in range(n)], [rnd.random() for _ in range(n)]
    assert len(html_extract.minimum_cut(a, b, [(i, i + 1, 0.5) for i in range(n - 1)])) == n
    assert time.perf_counter() - began < 60


def test_html_weights_against_gradient_and_labels():
    """The fitted weights are a minimum of the penalised loss, and blocks get the best of all labellings."""
    from itertools import product

    pages = [f"<nav><ul><li><a href=x>Item {i}</a></li></ul></nav><article><h1>Title {i}</h1><p>A sentence of some length, number {i}.</p><div class=xbox>Deep.</div></article><footer>End {i}</footer>" for i in range(8)]
    found = sum((html_extract.seeds(p) for p in pages), Counter())
    rows = [(k[0].split(), k[1], n) for k, n in found.items()]
    weights = html_extract.fitted(rows)
    total = Counter()
    for _, y, n in rows:
        total[y] += n
    for f in weights:
        slope = html_extract.DRIFT * (weights[f] - html_extract.PRIOR.get(f, 0.0))
        slope += sum(n / total[y] / 2 * (1 / (1 + math.exp(-sum(weights[x] for x in fs))) - y) for fs, y, n in rows if f in fs)
        assert abs(slope) < 1e-4
    assert html_extract.fitted([]) == html_extract.PRIOR and weights["tag:h1"] > 1.0 > weights["tag:li"]
    page = "<div>short</div><p>Is this kept.</p><div><a href=x>link</a></div><div class=sidebar><p>And this?</p></div><div>more words than before stand here</div>"
    blocks = html_extract.blocks_of(page)
    edges, capacity = html_extract.smoothness(blocks), [html_extract.costs(b, weights) for b in blocks]
    cost = lambda keep: sum(c[1] if k else c[0] for k, c in zip(keep, capacity, strict=True)) + sum(c for i, j, c in edges if keep[i] != keep[j])
    assert cost(html_extract.label_blocks(blocks, weights)) == pytest.approx(min(map(cost, product((False, True), repeat=len(blocks)))), abs=0.02)


def test_minimum_cut_against_all_labellings():
    from itertools import product

    rnd = random.Random(4)
    for _ in range(40):
        n = 6
        a, b = [rnd.random() * 3 for _ in range(n)], [rnd.random() * 3 for _ in range(n)]
        edges = [(i, j, rnd.random() * 2) for i in range(n) for j in range(i) if rnd.random() < 0.5]
        cost = lambda keep: sum(b[i] if keep[i] else a[i] for i in range(n)) + sum(c for i, j, c in edges if keep[i] != keep[j])  # noqa: E731, B023
        assert cost(html_extract.minimum_cut(a, b, edges)) == pytest.approx(min(map(cost, product((False, True), repeat=n))), abs=0.02)


def test_lm_scores_against_counting(spark):
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(12)] + ["Wörd"]
    rows = [(i, " ".join(rnd.choices(vocabulary, weights=range(1, 14), k=rnd.randrange(1, 30)))) for i in range(80)] + [(80, None), (81, " . "), (None, "v1 v2")]
    labels = [(i, i % 2, 0) for i in range(0, 80, 3)] + [(0, 0, 0), (None, 1, 0), (500, 1, 0)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    size = 9
    models = lm_scoring.fit(docs, table, wanted=F.col("quality") == 1, vocabulary=size)
    got = {r.doc_id: r for r in lm_scoring.score(docs.withColumn("score", F.lit("clash")), models).collect()}

    words = {d: brute.ALNUM.findall(brute.lower(t)) for d, t in rows}
    counts = Counter(x for w in words.values() for x in w)
    from spanloom.llm.wordhash import ALNUM_LOWER, tokenised
    import pyarrow as pa

    hashed = {w: int(next(tokenised(pa.array([w]), ALNUM_LOWER)).hashes().view(np.int64)[0]) for w in counts}
    known = set(sorted(counts, key=lambda w: (-counts[w], hashed[w]))[: size - 2])
    ids = {d: ["<s>", *(x if x in known else "<unk>" for x in w)] for d, w in words.items()}
    wanted = {d for d, q, _ in labels if q == 1 and d is not None}

    def model(docs_):
        pairs = Counter(p for d in docs_ for p in zip(ids[d], ids[d][1:], strict=False))
        first, nxt = Counter(), Counter()
        for (x, y), n in pairs.items():
            first[x] += n
            nxt[y] += n
        total = sum(nxt.values()) + size - 1
        return lambda x, y: -math.log((pairs[x, y] + lm_scoring.PRIOR * (nxt[y] + 1) / total) / (first[x] + lm_scoring.PRIOR))

    target, background = model(wanted & set(ids)), model(ids)
    for d, w in words.items():
        if not w:
            assert (got[d].n_tokens, got[d].score, got[d].target_loss) == (0, None, None)
            continue
        t, b = (sum(m(x, y) for x, y in zip(ids[d], ids[d][1:], strict=False)) / len(w) for m in (target, background))
        assert got[d].n_tokens == len(w) and got[d].target_loss == pytest.approx(t, rel=1e-5) and got[d].background_loss == pytest.approx(b, rel=1e-5) and got[d].score == pytest.approx(t - b, abs=1e-5)
    empty = docs.where("doc_id < 0")
    assert lm_scoring.score(empty, lm_scoring.fit(empty, table, wanted=F.col("quality") == 1, vocabulary=4)).count() == 0


def test_lm_scores_count_every_word(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(vocabulary[50 * i : 50 * i + 50] + rnd.choices(vocabulary, k=40))) for i in range(60)] + [(100, "w1 topical w3"), (101, "w1 remote w3"), (102, "w1 remote w3")]
    labels = [(i, i % 2, 0) for i in range(60)] + [(100, 1, 0)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = lm_scoring.fit(docs, table, wanted=F.col("quality") == 1)
    more = docs.union(spark.createDataFrame([(200, "w1 never seen")], docs.schema))
    got = {r.doc_id: r for r in lm_scoring.score(more, models).collect()}
    texts = {d: ["<s>", *t.split()] for d, t in rows}
    size = len({x for w in texts.values() for x in w[1:]}) + 1

    def model(ids):
        pairs = Counter(p for d in ids for p in zip(texts[d], texts[d][1:], strict=False))
        first, nxt = Counter(), Counter()
        for (x, y), n in pairs.items():
            first[x] += n
            nxt[y] += n
        total = sum(nxt.values()) + size
        return lambda x, y: -math.log((pairs[x, y] + lm_scoring.PRIOR * (nxt[y] + 1) / total) / (first[x] + lm_scoring.PRIOR))

    target, background = model({d for d, q, _ in labels if q == 1}), model(set(texts))
    assert len(got) == len(rows) + 1
    for d, w in (texts | {200: ["<s>", "w1", "never", "seen"]}).items():
        t, b = (sum(m(x, y) for x, y in zip(w, w[1:], strict=False)) / (len(w) - 1) for m in (target, background))
        assert got[d].n_tokens == len(w) - 1 and got[d].target_loss == pytest.approx(t) and got[d].background_loss == pytest.approx(b) and got[d].score == pytest.approx(t - b)
    assert got[100].score < got[101].score == pytest.approx(got[102].score)
    at_once = {r.doc_id: r for r in lm_scoring.fit_and_score(docs, table, wanted=F.col("quality") == 1).collect()}
    assert at_once == {d: r for d, r in got.items() if d != 200}


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|end|>\n<|start|>user", "\\", "<\\|[\\\\", "", None, "<|part|>", "a\nb", "é😀<"]
    rows = [(c, t, ("user", "assistant", "system", None)[(c + t // 2) % 4], odd[(c * 3 + t) % len(odd)]) for c in range(20) for t in range(7)] + [(3, 2, "user", "tie"), (3, 2, "user", "tie"), (None, 0, "assistant", "x"), (50, None, "assistant", "null turn"), (50, 0, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    chats = chat.format_chats(turns).withColumn("turns", chat.parsed_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append(((t is not None, t or 0), role or "", text or ""))
    got = {r.conv_id: r for r in chats.collect()}
    assert got.keys() == want.keys()
    for c, said in want.items():
        said.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [x[1:] for x in said]
        assert got[c].loss == "".join(x[2] for x in said if x[1] == "assistant")
        assert not any(s in got[c].formatted for s in ("[INST]", "</s>")) and got[c].formatted.count("<|message|>") == got[c].formatted.count("<|end|>\n")
    assert chat.format_chats(turns.where("conv_id = -5")).count() == 0


@pytest.mark.parametrize("scale", [1.0, 3e6])
def test_top_k_against_all_pairs(spark, scale):
    rnd = random.Random(7)
    rows = [(i, [float(np.float32(rnd.choice([-0.5, 0.25, 0.1, rnd.gauss(0, 1)]) * scale)) for _ in range(8)]) for i in range(300)]
    rows += [(i + 400, rows[i][1]) for i in range(60)] + [(500, None), (520, [1.0, None]), (540, [float("nan")] * 8), (560, [float("inf")] * 8), (None, [1.0] * 8), (600, [0.5]), (601, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    good = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    v = topk.integer_vectors(table)
    got = defaultdict(list)
    for r in topk.top_k(v, v.where("vec_id % 20 = 0"), 20, block=16, slice_blocks=3, batch=5, seeds=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in (i for i in good if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], c, strict=False)), i) for i, c in good.items() if i != q)[:20]
        assert got[q] == [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    few = table.where("vec_id IN (0, 1, 2)")
    assert topk.self_search(few).count() == 2 and topk.self_search(table.where("vec_id < 0")).count() == 0


def test_top_k_prunes_clusters(spark):
    """Blocks of other clusters never travel; the result is that of all pairs."""
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i * 7 % 12] + rnd.normal(size=16) / 8).tolist()) for i in range(3000)]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asks = v.where("vec_id % 20 = 0")
    blocks, asked, reaching = topk.plan(v, asks, 20, block=32, batch=40)
    share = reaching.agg(F.sum("asking")).first()[0] / (blocks.count() * asks.count())
    assert share < 0.3 and asked.count() >= 4
    got = defaultdict(list)
    for r in topk.top_k(v, asks, 20, block=32, batch=40).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    m = np.floor(64 * np.array([x for _, x in rows])).astype(np.int64)
    for q in range(0, 3000, 20):
        s = m @ m[q]
        best = sorted((i for i in range(3000) if i != q), key=lambda i: (-s[i], i))[:20]
        assert got[q] == [(i, s[i]) for i in best]


def test_all_queries_run_over_whole_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").count()
    for name in ("op1_toxicity", "op2_decontaminate", "op3_language_id", "op7_mixing", "op8_lm_scoring"):
        assert queries.QUERIES[name](spark, data).select("doc_id").distinct().count() == docs
    row = queries.QUERIES["op9_chat_format"](spark, data).where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars) == (2, len(text)) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def check_stages(spark, docs, sf_dir, folder):
    """Runs the stages on docs and compares each with a plain version on its own input."""
    columns = docs.columns
    rows = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{i}")
        before, docs = docs, spark.read.parquet(path)
        assert docs.columns == columns
        x, y = rows(before), rows(docs)
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from=~toxicity.held_out())
            weight = dict(zip(np.flatnonzero(model.slot).tolist(), model.weights[model.slot[model.slot > 0] - 1].tolist(), strict=True))
            grams = lambda t: {(int.from_bytes(t[p : p + n], "little") + n) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - toxicity.BITS for n in toxicity.ORDERS for p in range(len(t) - n + 1)}
            odds = lambda t: model.intercept + sum(weight.get(g, 0.0) for g in grams(brute.lower(t).encode()))
            assert Counter(y) == Counter(r for r in x if odds(r[1]) < 0)
        if name == "ngram_jaccard":
            component = brute.jaccard_components([r[:2] for r in x if r[0] is not None], 5, 80)
            # rows of one id are one node, of which one row stays
            assert Counter(r[0] for r in y) == Counter({d for d, c in component.items() if c == d}) + Counter(r[0] for r in x if r[0] is None) and set(y) <= set(x)
        if name == "substring_dedup":
            assert Counter((d, t) for d, t, _ in y) == Counter((d, t) for (d, _, _, t), n in brute.substring_dedup([r[:2] for r in x]).items() for _ in range(n))
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            judged = zip(x, brute.contamination_list([r[:2] for r in x], items), strict=True)
            assert Counter(y) == Counter(r for r, (_, n, hit, _) in judged if not (hit and 20 * hit >= n))
        if name == "mixing":
            sizes = Counter()
            for _, t, source in x:
                sizes[source] += len(brute.PLAIN.findall(t or ""))
            targets = brute.mix_targets(dict(sizes)) if x else {}
            want = Counter()
            for r in x:
                rate = targets[r[2]] / sizes[r[2]] if sizes[r[2]] else 0
                u = int(hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16) / 2**32
                want[r] += math.floor(rate) + (u < rate - math.floor(rate))
            assert Counter(y) == +want


def test_pipeline_stages_against_brute_force(spark, data, tmp_path):
    check_stages(spark, spark.read.parquet(f"{data}/documents.parquet"), data, tmp_path)


def test_pipeline_stages_on_odd_tables(spark, data, tmp_path):
    """Nulls in every column, repeated rows and ids, a very long text, columns that clash; then no rows at all."""
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40)
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(None, None, None, None, None), (None, "a b c", None, "s", 1), (None, "a b c", None, "s", 1), (7001, None, "en", None, None), (7002, "", None, "s", 0), (7003, long, "en", "s", 1), (7004, long + " more", "en", None, 1), (7005, "q r s t u v w", "en", "s", 1), (7005, "q r s t u v w", "en", "s", 1), (7006, "one two", None, None, None), (7006, "one two", None, None, None)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.unionByName(more).withColumns({"n_words": F.lit(1), "_id": F.lit("clash"), "id": F.lit(None).cast("string"), "label": F.lit(2), "size": F.lit(3)})
    check_stages(spark, odd, data, tmp_path / "odd")
    check_stages(spark, odd.where("doc_id = -1"), data, tmp_path / "empty")


def test_pipeline_keeps_one_folder(spark, data, tmp_path):
    import os

    from spanloom.llm.common import shared_folder

    out = corpus_pipeline.run(spark, data)
    left = [x for x in os.listdir(shared_folder(spark)) if x.startswith("corpus-pipeline-")]
    assert out.count() > 0 and all(os.listdir(f"{shared_folder(spark)}/{x}") == ["4-mixing"] for x in left)
