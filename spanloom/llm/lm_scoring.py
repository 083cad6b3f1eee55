"""LM scoring by cross-entropy difference.

Two bigram models share one vocabulary and one smoothing: the background model is counted over all
documents, the target model over those that labels mark as wanted.  Each token's loss is taken under
both; a document's score is its mean target loss minus its mean background loss, so the lower the
score the closer the document is to the target.

The vocabulary holds every word of the corpus, and one more word for all that scored texts add to it;
only where ``vocabulary`` is given, the ``vocabulary - 2`` most frequent words (equal counts by hash) are
kept and all others are one word.  The models are a table of counts that grows with the corpus and stays
in Spark: the counts of words, of words as contexts and of bigrams, each under a 56-bit key (54 bits of a
hash: of 10**9 keys about 30 pairs share one), dealt to shards by key.  Tasks add up what they count before they send it, so a frequent bigram is one entry of
each.  To score, documents are packed into chunks of bounded size; each chunk asks the shards once for
every key that it holds, and its losses are summed where the answers meet its texts.

Defined results: null, empty and wordless texts have n_tokens 0 and null losses and score; documents
without label are background only; of repeated labels the largest counts; without any target document
the target model is the uniform one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, checkpointed, forget_shuffles, text_bytes
from .wordhash import ALNUM_LOWER, U64, mix64, text_buffers, tokenised

PRIOR = 50.0
#: Bytes of text that one shard of the table and one chunk of documents stand for, and keys a task adds up before it sends them.
SHARD_BYTES, CHUNK_BYTES, PENDING = 16 << 20, 8 << 20, 1_500_000
CONTEXT, WORD, BIGRAM = U64(1), U64(2), U64(3)
BEGIN, OTHER = mix64(np.array([11, 12], U64))


def _count_words(batches):
    for batch in batches:
        found = [w.hashes() for w in tokenised(batch.column(0), ALNUM_LOWER)]
        words, n = np.unique(np.concatenate([*found, np.zeros(0, U64)]), return_counts=True)
        for a in range(0, len(words), 100_000):
            yield pa.RecordBatch.from_pydict({"word": words[a : a + 100_000].view(np.int64), "n": n[a : a + 100_000]})


def common_words(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """Hashes of the most frequent words, sorted."""
    counts = docs.select(F.col(text_col)).mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.col("n").desc(), "word").limit(size).collect()
    return np.sort(np.array([r.word for r in rows], np.int64).view(U64))


def _key(hashes: np.ndarray, kind: np.uint64) -> np.ndarray:
    return ((mix64(hashes + mix64(np.array([kind]))) >> U64(8)) & ~U64(3)) | kind


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, packed: the high bytes of small numbers cost nothing."""
    return zlib.compress(x.ravel().view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _numbers(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys, as their differences."""
    return _planes(np.diff(keys, prepend=U64(0)))


def _keys(blob: bytes) -> np.ndarray:
    return _numbers(blob, U64).cumsum(dtype=U64)


def _counts(blob: bytes) -> np.ndarray:
    return _numbers(blob, np.int64).reshape(2, -1)


@dataclass
class Grams:
    """The tokens of a word table: each is a bigram of a context and a word."""

    keys: np.ndarray  # of the contexts, the words and the distinct bigrams
    context: np.ndarray  # of each distinct bigram, as a place in keys
    word: np.ndarray
    bigram: np.ndarray  # of each token, as a place after first
    first: int  # place of the first bigram

    def counts(self, tokens=slice(None)) -> np.ndarray:
        """How often each key occurs in the tokens."""
        n = np.bincount(self.bigram[tokens], minlength=len(self.context))
        out = np.bincount(self.context, n, len(self.keys)) + np.bincount(self.word, n, len(self.keys))
        out[self.first :] = n
        return out.astype(np.int64)


def _grams(w, words: np.ndarray | None) -> Grams:
    """The begin of a text stands before its first word."""
    h = w.hashes()
    if words is not None:
        at = np.minimum(np.searchsorted(words, h), max(0, len(words) - 1))
        h = np.where(words[at] == h, h, OTHER) if len(words) else np.full(len(h), OTHER)
    known, ids = np.unique(h, return_inverse=True)
    v = len(known)
    before = np.concatenate(([v], ids[:-1])) if len(ids) else ids
    before[w.row_word[:-1][np.diff(w.row_word) > 0]] = v
    pairs, bigram = np.unique(before * (v + 1) + ids, return_inverse=True)
    x, y = pairs // (v + 1), pairs % (v + 1)
    before_hash = np.append(known, BEGIN)
    keys = np.concatenate((_key(before_hash, CONTEXT), _key(known, WORD), _key(mix64(before_hash[x]) * U64(3) + known[y], BIGRAM)))
    return Grams(keys, x, v + 1 + y, bigram, 2 * v + 1)


def _dealt(keys: np.ndarray, shards: int):
    """For each shard that has some of the keys: the shard and their places, in the order of keys."""
    shard = ((keys >> U64(2)) % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cut)).tolist():
        yield s, order[cut[s] : cut[s + 1]]


def _added(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their summed counts (2 rows: all documents, target documents)."""
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.stack([np.bincount(inverse, np.concatenate([c[i] for _, c in parts]), len(keys)) for i in (0, 1)]).astype(np.int64)


def _counted(w, wanted: np.ndarray, words: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    g = _grams(w, words)
    return g.keys, np.stack((g.counts(), g.counts(wanted[w.first_row + w.row])))


def _count(held: Broadcast | None, shards: int):
    def sent(keys, counts):
        for s, at in _dealt(keys, shards):
            yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "keys": [_squeezed(keys[at])], "counts": [_planes(counts[:, at])]})

    def count(batches):
        parts, pending = [], 0
        for batch in batches:
            wanted = batch.column("wanted").to_numpy(zero_copy_only=False)
            for w in tokenised(batch.column("text"), ALNUM_LOWER):
                if not len(w):
                    continue
                parts.append(_counted(w, wanted, held and held.value))
                pending += len(parts[-1][0])
                if pending > PENDING:
                    parts = [_added(parts)]
                    pending = len(parts[0][0])
                    if pending > PENDING // 2:
                        yield from sent(*parts[0])
                        parts, pending = [], 0
        if parts:
            yield from sent(*_added(parts))

    return count


def _sum_counts(table: pa.Table) -> pa.Table:
    keys, counts = _added([(_keys(k), _counts(c)) for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)])
    some = counts[0] > 0
    keys, counts = keys[some], counts[:, some]
    words = counts[:, keys & U64(3) == WORD]
    n = {"words": [words.shape[1]], "n_all": [int(words[0].sum())], "n_target": [int(words[1].sum())]}
    return pa.table({"shard": table["shard"][:1], "keys": [_squeezed(keys)], "counts": [_planes(counts)]} | n)


@dataclass
class Models:
    table: DataFrame  # shard, keys, counts
    shards: int
    words: np.ndarray | None  # the kept words where the vocabulary is limited
    size: int  # of the vocabulary, with the word for all others
    tokens: tuple[int, int]  # of all and of the target documents
    prior: float

    def log_probabilities(self, g: Grams, counts: np.ndarray) -> np.ndarray:
        """log P(word | context) of each distinct bigram, from the counts of its keys under both models:
        Dirichlet smoothing towards the unigrams, which are smoothed by one."""
        unigram = (counts[:, g.word] + 1) / (np.array(self.tokens)[:, None] + self.size)
        return np.log((counts[:, g.first :] + self.prior * unigram) / (counts[:, g.context] + self.prior))


def _with_wanted(docs: DataFrame, labels: DataFrame, wanted: Column, id_col: str, text_col: str) -> DataFrame:
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.coalesce(wanted, F.lit(False))).alias("wanted"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(marked.where("wanted").hint("shuffle_hash"), "_id", "left")
    return rows.select(F.col("_id").alias("id"), "text", F.coalesce("wanted", F.lit(False)).alias("wanted"))


_SUMS = "shard int, keys binary, counts binary, words long, n_all long, n_target long"


def _models(table: DataFrame, shards: int, words: np.ndarray | None, vocabulary: int | None, prior: float) -> Models:
    n = table.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "n_all", "n_target"))).first()
    return Models(table.select("shard", "keys", "counts"), shards, words, n[0] + 1 if vocabulary is None else vocabulary - 1, (n[1], n[2]), prior)


def fit(docs: DataFrame, labels: DataFrame, *, wanted: Column, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = None, prior: float = PRIOR, shard_bytes: int = SHARD_BYTES) -> Models:
    """wanted: a condition on labels that marks the target documents."""
    shards = bucket_count(text_bytes(docs, text_col), shard_bytes)
    words = None if vocabulary is None else common_words(docs, text_col, vocabulary - 2)
    held = None if words is None else docs.sparkSession.sparkContext.broadcast(words)
    parts = _with_wanted(docs, labels, wanted, id_col, text_col).mapInArrow(_count(held, shards), "shard int, keys binary, counts binary")
    return _models(checkpointed(parts.groupBy("shard").applyInArrow(_sum_counts, _SUMS)), shards, words, vocabulary, prior)


# ---------------------------------------------------------------- scoring
def _pack(batches):
    """Documents in chunks, each one row."""
    chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

    def row():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        return pa.RecordBatch.from_pydict({"chunk": [chunk], "body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    for batch in batches:
        ends, at = text_buffers(batch.column("text"))[1], 0
        while at < len(batch):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK_BYTES - size, "right")) - 1)
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop] - ends[at])
            at = stop
            if at < len(batch) or size >= CHUNK_BYTES:
                yield row()
                chunk, held, size = chunk + 1, [], 0
    if held:
        yield row()


def _unpack(bodies) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(body.as_py()).read_all() for body in bodies])


def _chunk_counts(rows: pa.Table, words: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    wanted = rows["wanted"].to_numpy()
    parts = [_counted(w, wanted, words) for w in tokenised(rows["text"], ALNUM_LOWER) if len(w)]
    return _added(parts) if parts else (np.zeros(0, U64), np.zeros((2, 0), np.int64))


_ASKED = "chunk long, shard int, keys binary, counts binary"


def _ask(held: Broadcast | None, shards: int):
    """The keys of each chunk, with their counts, one row per shard."""

    def ask(batches):
        for batch in batches:
            for chunk, body in zip(batch.column("chunk"), batch.column("body"), strict=True):
                keys, counts = _chunk_counts(_unpack([body]), held and held.value)
                for s, at in _dealt(keys, shards):
                    yield pa.RecordBatch.from_pydict({"chunk": [chunk.as_py()], "shard": pa.array([s], pa.int32()), "keys": [_squeezed(keys[at])], "counts": [_planes(counts[:, at])]})

    return ask


def _answer(asked: pa.Table, table: pa.Table) -> pa.Table:
    """The counts of the keys that each chunk asked for, in their order; 0 for unknown ones."""
    keys, counts = (_keys(table["keys"][0].as_py()), _counts(table["counts"][0].as_py())) if len(table) else (np.zeros(0, U64), np.zeros((2, 0), np.int64))
    bodies = []
    for blob in asked["keys"]:
        wanted = _keys(blob.as_py())
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        bodies.append(_planes(np.where(keys[at] == wanted, counts[:, at], 0) if len(keys) else np.zeros((2, len(wanted)), np.int64)))
    return pa.table({"chunk": asked["chunk"], "shard": asked["shard"], "body": pa.array(bodies, pa.binary())})


def _sum_and_answer(asked: pa.Table) -> pa.Table:
    """The answers from the sums of what was asked; the first row also has the sums of its shard."""
    table = _sum_counts(asked)
    out, later = _answer(asked, table), [None] * (len(asked) - 1)
    for c in ("words", "n_all", "n_target"):
        out = out.append_column(c, pa.array([table[c][0].as_py(), *later], pa.int64()))
    return out


def _losses(models: Models, held: Broadcast | None):
    def losses(packed: pa.Table, answers: pa.Table) -> pa.Table:
        rows, words = _unpack(packed["body"]), held and held.value
        texts, (keys, _) = rows["text"], _chunk_counts(rows, words)
        said = {s.as_py(): b for s, b in zip(answers["shard"], answers["body"], strict=True)}
        counts = np.zeros((2, len(keys)), np.int64)
        for s, places in _dealt(keys, models.shards):
            counts[:, places] = _counts(said[s].as_py())
        n, total = np.zeros(len(texts), np.int64), np.zeros((2, len(texts)))
        for w in tokenised(texts, ALNUM_LOWER):
            if not len(w):
                continue
            g, at = _grams(w, words), slice(w.first_row, w.first_row + w.n_rows)
            n[at] = np.diff(w.row_word)
            for i, p in enumerate(models.log_probabilities(g, counts[:, np.searchsorted(keys, g.keys)])):
                total[i, at] = -np.bincount(w.row, p[g.bigram], minlength=w.n_rows)
        none, (background, target) = n == 0, total / np.maximum(n, 1)
        columns = {"target_loss": target, "background_loss": background, "score": target - background}
        return pa.table({"id": rows["id"], "n_tokens": n} | {k: pa.array(v, mask=none) for k, v in columns.items()})

    return losses


def _scored(packed: DataFrame, answers: DataFrame, models: Models, held: Broadcast | None, id_col: str, id_type: str) -> DataFrame:
    plain = Models(None, models.shards, None, models.size, models.tokens, models.prior)
    schema = f"id {id_type}, n_tokens long, target_loss double, background_loss double, score double"
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_losses(plain, held), schema).withColumnRenamed("id", id_col)


def score(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: its id, n_tokens, target_loss, background_loss (means per token) and score."""
    held = None if models.words is None else docs.sparkSession.sparkContext.broadcast(models.words)
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(False).alias("wanted"))
    # kept, so that what a chunk asks for and what it is answered are about the same documents
    packed = checkpointed(df.mapInArrow(_pack, "chunk long, body binary"))
    asked = packed.mapInArrow(_ask(held, models.shards), _ASKED).drop("counts")
    answers = asked.groupBy("shard").cogroup(models.table.groupBy("shard")).applyInArrow(_answer, "chunk long, shard int, body binary")
    return _scored(packed, answers, models, held, id_col, docs.schema[id_col].dataType.simpleString())


def fit_and_score(docs: DataFrame, labels: DataFrame, *, wanted: Column, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """score(docs, fit(docs, labels)): what a chunk counts and what it asks for are sent once."""
    shards = bucket_count(text_bytes(docs, text_col), shard_bytes)
    packed = checkpointed(_with_wanted(docs, labels, wanted, id_col, text_col).mapInArrow(_pack, "chunk long, body binary"))
    forget_shuffles(docs.sparkSession)
    answers = checkpointed(packed.mapInArrow(_ask(None, shards), _ASKED).groupBy("shard").applyInArrow(_sum_and_answer, "chunk long, shard int, body binary, words long, n_all long, n_target long"))
    forget_shuffles(docs.sparkSession)
    models = _models(answers.withColumns({"keys": F.lit(None), "counts": F.lit(None)}), shards, None, None, prior)
    return _scored(packed, answers.select("chunk", "shard", "body"), models, None, id_col, docs.schema[id_col].dataType.simpleString())
