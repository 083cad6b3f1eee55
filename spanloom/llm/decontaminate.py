"""Benchmark decontamination by winnowed fingerprints.

Training texts and benchmark items keep the minimum k-gram hash of every window of
``span - k + 1`` k-grams.  Two equal runs of ``span`` words keep the same k-gram, so joining the
fingerprints finds every shared run of at least ``span`` words; each hit is then extended word by word
in both directions and kept only if the whole run reaches ``span`` words.  Items of fewer words than
``span`` are one window each and are looked up as a whole.

The benchmark is the smaller side: it is cut into blocks of at most ``block_words`` words (a longer item into
pieces that overlap by ``span - 1`` words), and each block's fingerprint index is broadcast to a pass of its
own, in which the documents are not shuffled.  Between passes the documents and their hits are written to the
shared folder and the index is released, so a larger benchmark means more passes, never a larger broadcast.
Fingerprints of more than ``HOT`` places in a block are not extended place by place: there the windows that
have this fingerprint are looked up as a whole.

Defined results: null or wordless texts have n_words = n_hit = 0 and no items; wordless or null items
match nothing; items sharing an item_id count once; a null item_id is reported as ''; repeated rows are
judged one by one; other columns are ignored, or carried through by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, checkpointed, frugal
from .wordhash import ALNUM_LOWER, U64, ngram_hashes, same_row, tokenised, winnow

SPAN, K, BLOCK_WORDS, HOT = 13, 5, 1_000_000, 64
_FOLD = str.maketrans(UPPER, LOWER)
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class BenchmarkIndex:
    """Fingerprints of one block of items."""

    def __init__(self, ids: list[str], texts: list[str | None], span: int, k: int, hot: int = HOT):
        self.ids, self.span, self.k = ids, span, k
        hashes, items, anchors, grams, windows = [], [], [], [], []
        self.short: dict[int, dict[int, list[int]]] = {}
        short, base = defaultdict(lambda: defaultdict(list)), 0
        for w in tokenised(pa.array(texts, pa.large_string()), ALNUM_LOWER):
            h = w.hashes()
            kept, fps, least = winnow(h, w.row, k, span)
            at = np.flatnonzero(least)
            windows.append((least[at], ngram_hashes(h, span)[at], (w.row + w.first_row)[at]))
            hashes.append(h)
            items.append(w.row + w.first_row)
            anchors.append(kept + base)
            grams.append(fps)
            for r in range(w.n_rows):
                lo, hi = w.row_word[r], w.row_word[r + 1]
                if 0 < hi - lo < span:
                    short[int(hi - lo)][int(ngram_hashes(h[lo:hi], int(hi - lo))[0])].append(w.first_row + r)
            base += len(h)
        self.words = np.concatenate([*hashes, np.zeros(0, U64)])
        self.item = np.concatenate([*items, np.zeros(0, np.int64)])
        anchors, grams = np.concatenate([*anchors, np.zeros(0, np.int64)]), np.concatenate([*grams, np.zeros(0, U64)])
        found, n = np.unique(grams, return_counts=True)
        self.hot = found[n > hot]
        cold = ~np.isin(grams, self.hot)
        anchors, grams = anchors[cold], grams[cold]
        order = np.argsort(grams, kind="stable")
        self.fps, self.at = grams[order], anchors[order]
        least, keys, owners = (np.concatenate([x[i] for x in windows] + [np.zeros(0, t)]) for i, t in enumerate((U64, U64, np.int64)))
        some = np.isin(least, self.hot)
        pairs = np.unique(np.stack((keys[some], owners[some].astype(U64))), axis=1)
        self.window_keys, self.window_items = pairs[0], pairs[1].astype(np.int64)
        bounds = np.searchsorted(self.item, np.arange(len(ids) + 1))
        self.first, self.last = bounds[:-1], bounds[1:]
        self.short = {m: dict(v) for m, v in short.items()}

    def hits(self, w, h: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, end word, item) of each run that covers a window of an item."""
        kept, fps, least = winnow(h, w.row, self.k, self.span)
        if len(self.hot):
            at = np.flatnonzero(np.isin(least, self.hot))
            keys = ngram_hashes(h, self.span)[at]
            first, last = np.searchsorted(self.window_keys, keys, "left"), np.searchsorted(self.window_keys, keys, "right")
            for a, x, y in zip(at[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist(), strict=True):
                for item in self.window_items[x:y].tolist():
                    yield a, a + self.span, item
        lo, hi = np.searchsorted(self.fps, fps, "left"), np.searchsorted(self.fps, fps, "right")
        done: dict[tuple[int, int], int] = {}  # by item and diagonal: where the last run ended
        for j in np.flatnonzero(hi > lo):
            p = int(kept[j])
            row_lo, row_hi = int(w.row_word[w.row[p]]), int(w.row_word[w.row[p] + 1])
            for q in self.at[lo[j] : hi[j]].tolist():
                item = int(self.item[q])
                if done.get((item, p - q), -1) > p:
                    continue
                left = min(p - row_lo, q - int(self.first[item]))
                right = min(row_hi - p, int(self.last[item]) - q)
                a, b = p - _common(h[p - left : p][::-1], self.words[q - left : q][::-1]), p + _common(h[p : p + right], self.words[q : q + right])
                if b - a >= self.span:
                    done[item, p - q] = b
                    yield a, b, item
        for m, table in self.short.items():
            grams = ngram_hashes(h, m)
            keys = np.fromiter(table, U64, len(table))
            for p in np.flatnonzero(np.isin(grams, keys) & same_row(w.row, m)).tolist():
                for item in table[int(grams[p])]:
                    if np.array_equal(h[p : p + m], self.words[self.first[item] : self.last[item]]):
                        yield p, p + m, item


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common prefix."""
    differ = x != y
    return int(np.argmax(differ)) if differ.any() else len(x)


def _pieces(text: str, words: int, block_words: int, span: int) -> Iterator[tuple[str, int]]:
    """A text of more than block_words words in pieces that share span - 1 words, so that no window is cut."""
    if words <= block_words:
        yield text, words
        return
    found, size = re.findall(_WORD, text.translate(_FOLD)), max(block_words, span)
    for a in range(0, len(found) - span + 1, size - span + 1):
        yield " ".join(found[a : a + size]), len(found[a : a + size])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, span: int, k: int, block_words: int) -> Iterator[BenchmarkIndex]:
    """Items are fetched one partition at a time and indexed block by block."""
    ids, texts, words = [], [], 0
    count = F.regexp_count(ascii_lower(text_col), F.lit(_WORD))
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col), count).where(F.col(text_col).isNotNull() & (count > 0))
    for item, text, total in rows.toLocalIterator():
        for piece, n in _pieces(text, total, block_words, span):
            if ids and words + n > block_words:
                yield BenchmarkIndex(ids, texts, span, k)
                ids, texts, words = [], [], 0
            ids.append(item)
            texts.append(piece)
            words += n
    if ids:
        yield BenchmarkIndex(ids, texts, span, k)


def _judge(texts, index: BenchmarkIndex, spans: list[list], items: list[set]) -> np.ndarray:
    """Adds this block's hits to spans and items; returns the word count of each row."""
    n_words = np.zeros(len(texts), np.int64)
    for w in tokenised(texts, ALNUM_LOWER):
        n_words[w.first_row : w.first_row + w.n_rows] = np.diff(w.row_word)
        for a, b, item in index.hits(w, w.hashes()):
            r = int(w.row[a])
            base = int(w.row_word[r])
            spans[w.first_row + r].append((a - base, b - base))
            items[w.first_row + r].add(index.ids[item])
    return n_words


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


_ADDED = "n_words long, n_hit long, item_ids array<string>, hit_spans array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _with_hits(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, span: int, k: int, block_words: int) -> DataFrame:
    """docs(doc, text) -> doc, n_words, n_hit, item_ids, hit_spans; doc is a struct that is carried."""
    sc = docs.sparkSession.sparkContext
    doc_type = docs.schema["doc"].dataType.simpleString()
    df = docs.select("doc", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"), F.array().cast("array<struct<start:int,end:int>>").alias("hit_spans"))
    held = None
    for index in _blocks(benchmark, item_col, item_text_col, span, k, block_words):
        if held is not None:  # the pass before is written and its index released before the next one begins
            df = checkpointed(df)
            held.destroy()
        held = sc.broadcast(index)

        def judge(batches, held=held):
            for batch in batches:
                spans = [[(s["start"], s["end"]) for s in x] for x in batch.column("hit_spans").to_pylist()]
                items = [set(x) for x in batch.column("item_ids").to_pylist()]
                n_words = _judge(batch.column("text"), held.value, spans, items)
                spans = [_merged(x) for x in spans]
                n_hit = [sum(b - a for a, b in x) for x in spans]
                out = {"doc": batch.column("doc"), "text": batch.column("text"), "n_words": pa.array(n_words), "n_hit": pa.array(n_hit, pa.int64())}
                out["item_ids"] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                out["hit_spans"] = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], _SPANS)
                yield pa.RecordBatch.from_pydict(out)

        df = df.mapInArrow(frugal(judge), f"doc {doc_type}, text string, {_ADDED}")
    if held is None:  # no item has words: only the documents' words are counted
        df = df.withColumn("n_words", F.coalesce(F.regexp_count(ascii_lower("text"), F.lit(_WORD)), F.lit(0)).cast("long"))
    return df


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, k: int = K, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of docs: its id, n_words, n_hit, item_ids (sorted) and hit_spans (word positions)."""
    slim = docs.select(F.struct(F.col(id_col).alias("id")).alias("doc"), F.col(text_col).alias("text"))
    df = _with_hits(slim, benchmark, item_col, item_text_col, span, k, block_words)
    return df.select(F.col("doc.id").alias(id_col), "n_words", "n_hit", "item_ids", "hit_spans")


def is_contaminated(n_words="n_words", n_hit="n_hit"):
    """At least a twentieth of the words lie in windows of benchmark items."""
    return (F.col(n_hit) > 0) & (F.lit(20) * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated."""
    item_col, item_text = options.pop("item_col", "item_id"), options.pop("item_text_col", "text")
    others = [c for c in docs.columns if c != text_col]
    slim = docs.select(F.struct(*others).alias("doc") if others else F.struct(F.lit(0).alias("_")).alias("doc"), F.col(text_col).alias("text"))
    df = _with_hits(slim, benchmark, item_col, item_text, options.get("span", SPAN), options.get("k", K), options.get("block_words", BLOCK_WORDS))
    return df.where(~is_contaminated()).select(*(F.col("text").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns))
