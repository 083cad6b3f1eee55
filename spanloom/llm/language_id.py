"""Language ID: script ranges narrow the candidates, Viterbi labels spans of mixed-language text.

Training takes a bounded sample of distinct labelled texts per language (``sample_rows`` each, chosen by a
hash of the text; a language of no more distinct texts is learned whole) and keeps hashed byte n-gram
log-probabilities and the share of letters in each script.  A word's score in a language is the sum over its
n-grams (word borders included).  Languages that hardly use the script of a word are no candidates for it,
unless none does.  Viterbi over the words of a text, with one penalty for every switch, labels each word; it
runs over many texts at once, column by column.  The text's language is the one with most bytes of words
that hold a letter; the score is its share.

Letters are the code points of Unicode category L; those of no listed script are one more script.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text if the
training set is empty; words that the training texts lack get the language whose smoothed n-grams fit best,
ties go to the first language by code point; languages are whatever the training labels hold, at most
``MAX_LANGUAGES`` (more are an error: the model holds a column for each); rows that share an id stay apart;
other columns are ignored.  Predictions don't depend on how texts fall into batches.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_of_id
from .wordhash import ALNUM_LOWER, U64, tokenised

BITS, ORDERS, SAMPLE_ROWS, PENALTY, MIN_SHARE = 16, (1, 2, 3, 4), 1000, 12.0, 0.01
CELLS = 1 << 22  # words times texts that Viterbi holds at once
MAX_LANGUAGES = 500

#: Script ranges of Unicode, in code points.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "Cyrillic": [(0x400, 0x52F)], "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)], "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)], "Devanagari": [(0x900, 0x97F)], "Bengali": [(0x980, 0x9FF)], "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)], "Thai": [(0xE00, 0xE7F)], "Georgian": [(0x10A0, 0x10FF)], "Ethiopic": [(0x1200, 0x137F)], "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)], "Hangul": [(0xAC00, 0xD7AF)],
}
#: 0: no letter; then the listed scripts; last the letters of all others.
N_SCRIPTS = len(SCRIPTS) + 2
_LAST_LETTER = 0x3FFFF


@cache
def _script_table() -> np.ndarray:
    """Script of every code point up to the last plane that has letters."""
    table = np.array([N_SCRIPTS - 1 if unicodedata.category(chr(c))[0] == "L" else 0 for c in range(_LAST_LETTER + 1)], np.int8)
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for lo, hi in ranges:
            part = table[lo : hi + 1]
            part[part > 0] = i
    return table


def _scripts(data: np.ndarray) -> np.ndarray:
    """Script of the character that starts at each byte; 0 for inner bytes and what is no letter."""
    table = _script_table()
    out = table[np.where(data < 0x80, data, 0)]
    at = np.flatnonzero(data >= 0xC2)
    if len(at):
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        b0, b1, b2, b3 = (padded[at + i].astype(np.int64) for i in range(4))
        tail = lambda b: b & 0x3F
        code = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | tail(b1), np.where(b0 < 0xF0, (b0 & 0xF) << 12 | tail(b1) << 6 | tail(b2), (b0 & 7) << 18 | tail(b1) << 12 | tail(b2) << 6 | tail(b3)))
        out[at] = np.where(code <= _LAST_LETTER, table[np.minimum(code, _LAST_LETTER)], 0)
    return out


def _grams(w):
    """Hashed n-grams at the blank before the first byte and at each byte, one array per order, with the places
    of those that reach beyond the blank after their row; words are framed by the bytes around them."""
    inside = w.kind.is_word[w.data]
    data = np.concatenate((np.full(1, 0x20, U64), np.where(inside, w.kind.fold[w.data], 0x20).astype(U64)))
    code = data
    ends = w.row_byte[1:]  # the blank after each row, which is the blank before the next one
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            code = code[:-1] | (data[n - 1 :] << U64(8 * (n - 1)))
        if n in ORDERS:
            beyond = np.append((ends[:, None] - np.arange(1, n - 1)).ravel(), ends[-1:])[: None if n == 1 else -1]
            yield n, (((code + U64(n << 40)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - BITS)).astype(np.int32), beyond[(beyond >= 0) & (beyond < len(code))]


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # hashed n-gram x language
    allowed: np.ndarray  # script x language

    def word_scores(self, w) -> tuple[np.ndarray, np.ndarray]:
        """Words x languages, and which words have a letter."""
        per_byte = np.zeros((len(w.data) + 1, len(self.languages)), np.float32)
        for _, grams, beyond in _grams(w):
            # an n-gram counts at its first byte; those that begin at the blank before a word count for the word
            values = self.logp[grams]
            values[beyond] = 0
            per_byte[: len(grams)] += values
        cuts = np.stack((w.starts, w.ends + 1), axis=1).ravel()
        sums = np.add.reduceat(per_byte, np.minimum(cuts, len(per_byte) - 1), axis=0)[0::2] if len(cuts) else np.zeros((0, len(self.languages)), np.float32)
        script = _scripts(w.data)
        letter = np.concatenate(([0], np.cumsum(script > 0)))
        has = letter[w.ends] > letter[w.starts]
        at = np.flatnonzero(script > 0)
        first = np.zeros(len(w), np.int64)
        first[has] = script[at[np.searchsorted(at, w.starts[has])]]
        sums[~self.allowed[first]] -= 1e4
        sums[~has] = 0
        return sums, has

    def label(self, texts, penalty: float):
        """Language (-1: none), score and labelled word spans of each text."""
        best, share, spans = np.full(len(texts), -1), np.zeros(len(texts)), [[] for _ in range(len(texts))]
        for w in tokenised(texts, ALNUM_LOWER):
            if not len(w) or not self.languages:
                continue
            sums, has = self.word_scores(w)
            path = viterbi(sums, w.row_word, penalty)
            weight = np.where(has, w.ends - w.starts, 0)
            votes = np.bincount(w.row * len(self.languages) + path, weight, minlength=w.n_rows * len(self.languages)).reshape(w.n_rows, -1)
            total = votes.sum(axis=1)
            rows = np.flatnonzero(total > 0)
            best[w.first_row + rows] = votes[rows].argmax(axis=1)
            share[w.first_row + rows] = votes[rows].max(axis=1) / total[rows]
            cuts = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (w.row[1:] != w.row[:-1]))))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(path)], strict=True):
                r = w.row[a]
                spans[w.first_row + r].append({"start": int(a - w.row_word[r]), "end": int(b - w.row_word[r]), "lang": self.languages[path[a]]})
        return best, share, spans


def viterbi(scores: np.ndarray, cut: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word: texts are scores[cut[i]:cut[i+1]], every switch costs penalty."""
    out = np.zeros(len(scores), np.int64)
    n = np.diff(cut)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    a = 0
    while a < len(order):
        length = int(n[order[a]])
        b = a + max(1, CELLS // length)
        rows = order[a:b]
        a = b
        starts, left = cut[rows], n[rows]
        value = scores[starts].astype(np.float64)
        stayed = np.ones((length, len(rows), scores.shape[1]), bool)
        source = np.zeros((length, len(rows)), np.int16)
        alive = np.searchsorted(-left, -np.arange(length), "left")  # texts of more than t words come first
        for t in range(1, length):
            m = alive[t]
            v = value[:m]
            source[t, :m] = top = v.argmax(axis=1)
            switch = v[np.arange(m), top][:, None] - penalty
            stayed[t, :m] = v >= switch
            value[:m] = np.maximum(v, switch) + scores[starts[:m] + t]
        now = value.argmax(axis=1)
        for t in range(length - 1, -1, -1):
            m = alive[t] if t else len(rows)
            out[starts[:m] + t] = now[:m]
            if t:
                keep = stayed[t, np.arange(m), now[:m]]
                now[:m] = np.where(keep, now[:m], source[t, :m])
    return out


def _count(table: pa.Table) -> pa.Table:
    counts, scripts = np.zeros(1 << BITS, np.int64), np.zeros(N_SCRIPTS, np.int64)
    for w in tokenised(table["text"], ALNUM_LOWER):
        for _, grams, beyond in _grams(w):
            counts += np.bincount(np.delete(grams, beyond), minlength=1 << BITS)
        scripts += np.bincount(_scripts(w.data), minlength=N_SCRIPTS)
    return pa.table({"lang": table["lang"][:1], "counts": [counts.tobytes()], "scripts": [scripts.tobytes()]})


def fit(docs: DataFrame, *, learn_from: Column, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # a share of the distinct texts of each language that gives about sample_rows of them; a tenth more, for the estimate
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("texts")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training labels")
    shares = rows.sparkSession.createDataFrame([(r.lang, min(1.0, 1.1 * sample_rows / max(1, r.texts))) for r in sizes], "lang string, share double")
    picked = rows.join(F.broadcast(shares), "lang")  # at most MAX_LANGUAGES rows
    picked = picked.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.col("share") * 1_000_000).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    counted = picked.groupBy("lang").applyInArrow(_count, "lang string, counts binary, scripts binary").collect()
    counted.sort(key=lambda r: r.lang)
    if not counted:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    counts = np.stack([np.frombuffer(r.counts, np.int64) for r in counted], axis=1).astype(float)
    logp = np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * (1 << BITS))
    logp -= logp.mean(axis=1, keepdims=True)
    scripts = np.stack([np.frombuffer(r.scripts, np.int64) for r in counted], axis=0).astype(float)
    scripts[:, 0] = 0
    used = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= MIN_SHARE).T
    allowed = np.where(used.any(axis=1, keepdims=True), used, True)
    return Model([r.lang for r in counted], logp.astype(np.float32), allowed)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """Per row of docs: its id, lang_pred, score, lang_spans (word positions)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            best, share, spans = held.value.label(texts, penalty)
            names = [held.value.languages[b] if b >= 0 else "und" for b in best.tolist()]
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": share, "lang_spans": pa.array(spans, _SPANS)})

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, lang_spans array<struct<start:int,end:int,lang:string>>"
    return df.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(crc32_of_id(id_col), F.lit(4)) == 2
