"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed character n-grams (3 to 6 bytes of the text with A-Z lower-cased), present or
absent in a whole text.  Training takes a bounded sample of labelled rows (``sample_rows``, chosen by a
hash of the id, equal texts once): the presence counts of both classes give each feature its log-count
ratio, all telling ones are kept (or the ``n_features`` most telling ones), and an L2-regularised
logistic regression is fitted on ratio-scaled presences.  The kept features of the sample stay in Spark:
each step of L-BFGS sends the weights out and sums the tasks' partial gradients.  Only vectors of the
2**20 hashed n-grams reach the driver.  Scoring is one narrow pass with two broadcast tables of fixed size.

Defined results: null and empty texts have no features and get the score of the intercept; rows without
a label train nothing; of repeated labels the largest counts; without any labelled row, or with only one
class, every score is the smoothed share of toxic labels; repeated rows are scored one by one; an empty
table gives an empty result; other columns are ignored, or carried through by ``drop_toxic``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc32_of_id, frugal
from .wordhash import PLAIN_LOWER, U64, tokenised

ORDERS, BITS, SAMPLE_ROWS, N_FEATURES = (3, 4, 5, 6), 20, 20_000, None
_FOLD = 5
#: Bytes of text handled at once, and rows of one slice of a gradient: both bound memory only.
CHUNK, SLICE_ROWS = 1 << 18, 250


@dataclass
class Model:
    slot: np.ndarray  # hashed n-gram -> 1 + its kept feature, 0 if not kept
    weights: np.ndarray  # of the kept features, their ratios multiplied in
    intercept: float

    def scores(self, texts) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        for rows, features, first, n in kept_features(texts, self.slot):
            out[first : first + n] += np.bincount(rows, self.weights[features], minlength=n)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _ngrams(w):
    """For each order: the hashed n-gram that starts at each byte of a chunk, and its order."""
    data = w.kind.fold[w.data].astype(U64)
    code = data.copy()
    for n in range(2, max(ORDERS) + 1):
        code = code[:-1] | (data[n - 1 :] << U64(8 * (n - 1)))
        if n in ORDERS:
            yield n, ((code + U64(n)) * U64(0x9E3779B97F4A7C15) >> U64(64 - BITS)).astype(np.int32)


def kept_features(texts, slot: np.ndarray):
    """Distinct (row, feature) pairs of each chunk of texts: rows, features, first row, rows."""
    size = int(slot.max(initial=0)) + 1
    for w in tokenised(texts, PLAIN_LOWER, CHUNK):
        found = []
        for n, grams in _ngrams(w):
            feature = slot[grams]
            at = np.flatnonzero(feature)
            row = np.searchsorted(w.row_byte, at, "right") - 1
            inside = at + n <= w.row_byte[row + 1] - 1  # the last byte of a row is its added blank
            found.append(row[inside] * size + feature[at[inside]])
        pairs = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]))
        yield pairs // size, pairs % size - 1, w.first_row, w.n_rows


def _count_presences(batches):
    counts, rows = np.zeros((2, 1 << BITS), np.uint32), np.zeros(2, np.int64)
    everything = np.arange(1, (1 << BITS) + 1, dtype=np.int32)
    for batch in batches:
        label = batch.column("label").to_numpy()
        rows += np.bincount(label, minlength=2)
        for row, feature, first, _ in kept_features(batch.column("text"), everything):
            for y in (0, 1):
                counts[y] += np.bincount(feature[label[first + row] == y], minlength=1 << BITS).astype(np.uint32)
    if rows.sum():
        yield pa.RecordBatch.from_pydict({"n0": [int(rows[0])], "n1": [int(rows[1])], "counts": [zlib.compress(counts.tobytes(), 1)]})


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn_from: Column, sample_rows: int) -> DataFrame:
    """At most sample_rows texts with labels, equal texts once: text, label."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn_from)
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    rows = docs.where(learn_from).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    joined = rows.join(F.broadcast(known), "_id")  # at most sample_rows rows of two numbers
    return joined.groupBy(F.md5("text").alias("h")).agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, *, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, n_features: int | None = N_FEATURES, alpha: float = 1.0, tasks: int = 8) -> Model:
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, learn_from, sample_rows).repartition(tasks).persist()
    try:
        parts = sample.mapInArrow(frugal(_count_presences), "n0 long, n1 long, counts binary").collect()
        n = np.array([[p.n0, p.n1] for p in parts]).reshape(-1, 2).sum(axis=0)
        prior = float(np.log((n[1] + alpha) / (n[0] + alpha)))
        nothing = Model(np.zeros(1 << BITS, np.int32), np.zeros(1), prior)
        if not n.all():
            return nothing
        counts = np.zeros((2, 1 << BITS), np.float32)
        for part in parts:
            counts += np.frombuffer(zlib.decompress(part.counts), np.uint32).reshape(2, -1)
        del parts
        ratio = np.log((counts[1] + alpha) / (n[1] + 2 * alpha)) - np.log((counts[0] + alpha) / (n[0] + 2 * alpha))
        spread = np.sqrt(1 / (counts[1] + alpha) + 1 / (counts[0] + alpha))
        telling = np.where(counts.sum(axis=0) >= 3, np.abs(ratio) / spread, 0)
        kept = np.argsort(-telling, kind="stable")[:n_features]
        kept = kept[telling[kept] > 2]
        if not len(kept):
            return nothing
        slot = np.zeros(1 << BITS, np.int32)
        slot[kept] = np.arange(1, len(kept) + 1)
        held = docs.sparkSession.sparkContext.broadcast(slot)

        table = checkpointed(sample.mapInArrow(frugal(_presences(held)), "label binary, sizes binary, features binary"))
    finally:
        sample.unpersist()
    weights, intercept = _logistic(table, ratio[kept].astype(np.float64), prior, int(n.sum()))
    return Model(slot, weights, intercept)


def _presences(held):
    """Slices of rows: their labels, numbers of kept features and features."""

    def presences(batches):
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = [(np.bincount(row, minlength=n), feature) for row, feature, _, n in kept_features(part.column("text"), held.value)]
                sizes, features = (np.concatenate(x).astype(np.uint32).tobytes() for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_pydict({"label": [part.column("label").to_numpy().astype(np.uint8).tobytes()], "sizes": [sizes], "features": [features]})

    return presences


def _partial(held):
    """Per task the logistic loss of its rows and its gradient by the weights and the intercept."""

    def partial(batches):
        ratio, x = held.value
        scaled, loss, g = ratio * x[:-1], 0.0, np.zeros(len(x))
        for batch in batches:
            for label, sizes, features in zip(*(batch.column(c).to_pylist() for c in ("label", "sizes", "features")), strict=True):
                y, col = np.frombuffer(label, np.uint8), np.frombuffer(features, np.uint32)
                row = np.repeat(np.arange(len(y)), np.frombuffer(sizes, np.uint32))
                z = x[-1] + np.bincount(row, scaled[col], minlength=len(y))
                off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
                loss += float((np.logaddexp(0, z) - y * z).sum())
                g[:-1] += np.bincount(col, off[row], minlength=len(ratio))
                g[-1] += off.sum()
        g[:-1] *= ratio
        yield pa.RecordBatch.from_pydict({"loss": [loss], "gradient": [g.tobytes()]})

    return partial


def _logistic(table: DataFrame, ratio: np.ndarray, prior: float, rows: int, l2: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on presences scaled by their ratios; the gradients are summed in Spark."""
    sc = table.sparkSession.sparkContext

    def value(x):
        held = sc.broadcast((ratio, x))
        parts = table.mapInArrow(_partial(held), "loss double, gradient binary").collect()
        held.destroy()
        g = sum(np.frombuffer(p.gradient) for p in parts)
        g[:-1] += l2 * x[:-1]
        return sum(p.loss for p in parts) + l2 / 2 * float(x[:-1] @ x[:-1]), g

    x = minimised(value, np.append(np.zeros(len(ratio)), prior), 1e-5 * rows)
    return x[:-1] * ratio, float(x[-1])


def minimised(value, x: np.ndarray, enough: float, steps: int = 100, memory: int = 8) -> np.ndarray:
    """Minimum of a convex function by L-BFGS; value gives the function and its gradient."""
    (best, g), pairs = value(x), []
    for _ in range(steps):
        if np.abs(g).max() <= enough:
            break
        q, taken = g.copy(), []
        for s, y in reversed(pairs):
            taken.append(s @ q / (s @ y))
            q -= taken[-1] * y
        q *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / np.linalg.norm(g)
        for (s, y), a in zip(pairs, reversed(taken), strict=True):
            q += s * (a - y @ q / (s @ y))
        step = 1.0
        while True:
            new = x - step * q
            least, h = value(new)
            if least <= best - 1e-4 * step * (g @ q):
                break
            step /= 2
            if step < 1e-6:
                return x
        if (new - x) @ (h - g) > 1e-12:
            pairs = [*pairs[1 - memory :], (new - x, h - g)]
        x, best, g = new, least, h
    return x


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: its id and score (0 to 1, higher: likelier toxic)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "score": held.value.scores(batch.column(1))})

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return df.mapInArrow(frugal(run), f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score below the threshold."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(held.value.scores(batch.column(batch.schema.get_field_index(text_col))) < threshold))

    return docs.mapInArrow(frugal(run), docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(crc32_of_id(id_col), F.lit(_FOLD)) == 0
