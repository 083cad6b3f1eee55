"""Periodic run detection: stretches of words that repeat with a smallest period, found by a sparse diagonal DP.

A diagonal is a lag: word i lies on diagonal q with its earlier occurrence at i - q.  The words of a text arrive in
order; each one's earlier occurrences increment the match lengths of their diagonals, a diagonal that is not
incremented has ended, and if its length suffices it gives a run at once: m matches at lag q are m + q words of
period q.

A common word has too many earlier occurrences to follow them all, and most can never matter: a run of period q
needs at least q matches in a row.  So diagonals of lags 2k to 4k - 1 (k a power of two; lags 1 to 3 for k = 1) go in
steps of k words: the blocks at every k-th place are the words of that scale, only their occurrences at those
lags count, and the last steps before and after are read off word by word.  q matches cover a whole block, so
no run is lost; every scale takes two comparisons a word, whatever the text (one word repeated throughout,
too), so n words take O(n log n).  Blocks and stretches are compared by 64-bit hashes, and runs word by word at the end.

Of several periods of one stretch the smallest stays: the others are its multiples, which have the same ends.

Defined results: null or empty text, and texts of fewer than ``least`` words, have no runs; rows are judged one by one, so
ties, repeated ids and null ids do not matter; an empty table gives an empty result; other columns are ignored,
or carried through when named in ``carry``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal
from .wordhash import PLAIN, U64, Words, mix64, powers, tokenised

LEAST = 12
#: Comparisons of blocks made at once.
TILE = 1 << 20
_RUNS = "array<struct<start:long,length:long,period:long>>"


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(size) else 0)


class _Equal:
    """Tells by hashes whether stretches of words are equal, and how far two places agree."""

    def __init__(self, words: np.ndarray):
        pow_, self.inv = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, U64)
        np.cumsum(words * pow_[:-1], out=self.sums[1:])

    def same(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[x + size] - self.sums[x]) * self.inv[x] == (self.sums[y + size] - self.sums[y]) * self.inv[y]

    def ahead(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from x and y on agree, most at most."""
        low, high = np.zeros(len(x), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.same(x, y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def behind(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(x), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.same(x - mid, y - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _matches(blocks: np.ndarray, places: np.ndarray, begins: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the blocks at the places that also stand lag words earlier in their text."""
    rows, found = max(1, TILE // len(lags)), []
    for a in range(0, len(places), rows):
        at, begin = places[a : a + rows], begins[a : a + rows]
        before = at[:, None] - lags[None, :]
        equal = (blocks[np.maximum(before, 0)] == blocks[at][:, None]) & (before >= begin[:, None])
        i, j = np.nonzero(equal)
        found.append((at[i], lags[j]))
    return tuple(np.concatenate([*(f[n] for f in found), np.zeros(0, np.int64)]).astype(np.int64) for n in (0, 1))


def find_runs(words: np.ndarray, row_word: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words: 64-bit hashes of the words of all texts; row_word: where each text begins, and the end.
    Returns row, start (word of the text), length and period of every run, by row, start and period."""
    n = np.diff(row_word)
    equal, blocks, k, out = _Equal(words), words, 1, []
    while k == 1 or 4 * k <= n.max(initial=0):
        some = np.flatnonzero(n >= max(least, 4 * k))
        lags = np.arange(1, 4) if k == 1 else np.arange(2 * k, 4 * k)
        skip = 1 if k == 1 else 2  # blocks before the first that can have an earlier occurrence at these lags
        count = np.maximum(n[some] // k - skip, 0)
        places = np.repeat(row_word[some], count) + _ragged(np.full(len(some), skip), count) * k
        owner = np.repeat(some, count)
        at, lag = _matches(blocks, places, row_word[owner], lags)
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        opens = np.ones(len(at), bool)  # a diagonal goes on while the next block is incremented as well
        opens[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + k)
        heads = np.flatnonzero(opens)
        first, last, lag = at[heads], at[np.concatenate((heads[1:], [len(at)])) - 1] + k if len(at) else at, lag[heads]
        need = np.maximum(least - lag, lag)
        able = last - first + 2 * (k - 1) >= need
        first, last, lag, need = first[able], last[able], lag[able], need[able]
        row = np.searchsorted(row_word, first, "right") - 1
        first = first - equal.behind(first, first - lag, np.minimum(k - 1, first - lag - row_word[row]))
        last = last + equal.ahead(last, last - lag, np.minimum(k - 1, row_word[row + 1] - last))
        long = last - first >= need
        out.append(np.stack((row, first - lag - row_word[row], last - first + lag, lag))[:, long])
        blocks = mix64(blocks[:-k] * U64(0x9E3779B97F4A7C15) + mix64(blocks[k:])) if len(blocks) > k else blocks[:0]
        k *= 2
    runs = np.concatenate(out, axis=1)
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    fresh = np.ones(runs.shape[1], bool)
    fresh[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    runs = _checked(words, row_word, runs[:, fresh])
    return tuple(runs[:, np.lexsort((runs[3], runs[1], runs[0]))])


def _checked(words: np.ndarray, row_word: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Every run compared word by word; equal hashes of unequal stretches would be an error, not a wrong result."""
    for a in range(0, runs.shape[1], 256):
        row, start, length, period = runs[:, a : a + 256]
        at = _ragged(row_word[row] + start + period, length - period)
        if (words[at] != words[at - np.repeat(period, length - period)]).any():
            raise ArithmeticError("two unequal stretches of words have one hash")
    return runs


def _collapsed(w: Words, keep: np.ndarray) -> list[str]:
    """Each row's kept words joined by one blank."""
    size = (w.ends - w.starts + 1)[keep]  # with the blank that follows
    data = w.data.copy()
    data[w.ends] = 0x20
    text = data[_ragged(w.starts[keep], size)].tobytes()
    bytes_ = np.concatenate(([0], np.cumsum(size)))
    cut = bytes_[np.concatenate(([0], np.cumsum(keep)))[w.row_word]].tolist()
    return [text[a:b][:-1].decode() for a, b in zip(cut, cut[1:], strict=False)]


def _of_texts(column: pa.Array, least: int) -> tuple[pa.Array, pa.Array]:
    starts, lengths, periods, sizes, texts = [], [], [], [], []
    for w in tokenised(column, PLAIN):
        row, start, length, period = find_runs(w.hashes(), w.row_word, least)
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, w.row_word[row] + start + period, 1)
        np.add.at(edge, w.row_word[row] + start + length, -1)
        texts += _collapsed(w, np.cumsum(edge)[:-1] <= 0)
        starts.append(start)
        lengths.append(length)
        periods.append(period)
        sizes.append(np.bincount(row, minlength=w.n_rows))
    cat = lambda x: np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    runs = pa.StructArray.from_arrays([pa.array(cat(x)) for x in (starts, lengths, periods)], ["start", "length", "period"])
    offsets = np.concatenate(([0], np.cumsum(cat(sizes)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(texts, pa.string())


def periodic_runs(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None, least: int = LEAST) -> DataFrame:
    """Per row of docs: the carried columns (doc_id if none are named), runs by start and period, collapsed (the text
    without the words that a run holds after its first period, joined by one blank).  One narrow pass, no shuffle."""
    carry = ["doc_id"] if carry is None else list(carry)

    def detect(batches):
        for batch in batches:
            runs, texts = _of_texts(batch.column("text"), least)
            yield pa.RecordBatch.from_arrays([*(batch.column(f"c{i}") for i in range(len(carry))), runs, texts], [*(f"c{i}" for i in range(len(carry))), "runs", "collapsed"])

    slim = docs.select(F.col(text_col).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    types = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    out = slim.mapInArrow(frugal(detect), f"{types}runs {_RUNS}, collapsed string")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "runs", "collapsed")
