"""Substring dedup: suffix automata of reference shards give the matching statistics of streamed texts.

``remove_reference_spans`` is the plain form: the reference is a bounded set of texts, cut into shards;
the automaton of each shard is broadcast (as its words) and every document streams through it.

``dedup_substrings`` removes what a corpus repeats of itself.  There the reference grows with the
documents, so shards are not broadcast: they are dealt by content, and only what can match travels.

1.  Documents are dealt into buckets of bounded size.  Winnowing keeps one 6-gram of every 20-word
    window (its anchor), the same one in every copy of that window.
2.  Anchors are counted: per bucket each anchor is sent once, so that a passage of every third document
    costs one row per bucket.  Anchors that occur once cannot lie in a repeated window.
3.  For each repeated anchor its bucket sends the piece of text around it: the windows that have this
    anchor, 20 to 34 words.  Equal pieces of a bucket are sent once; the later ones are repeats anyway.
    Anchors of more than ``hot`` places send their windows one by one, dealt by the window's own
    content, so no anchor collects an unbounded group.
4.  A shard holds all pieces of its anchors.  They enter one suffix automaton per anchor, in the order
    of documents; the automaton's matching statistic at each word is the longest suffix that started
    earlier, and windows are removed where it reaches 20 words.  Two equal windows always share their
    anchor, so no shard needs another one.
5.  Buckets get the verdicts back, delete the covered words and join the kept ones by one blank.

Defined results: doc_id is a whole number (other types are an error); the order is (doc_id, start); a null
doc_id comes before all others; rows that share a doc_id are ordered by the 64-bit hash of their text, and
spread over buckets by it.  Null or empty text: no words, kept text ''.  Other columns are ignored, or carried
through when named in ``carry``.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, frugal, text_bytes, whole_number_id
from .suffix_automaton import SuffixAutomaton
from .wordhash import PLAIN, U64, Words, ngram_hashes, tokenised, winnow

SPAN, K, HOT, BUCKET_BYTES = 20, 6, 2000, 8 << 20
_MESSAGE = "bucket int, kind int, keys binary, more binary"


# ---------------------------------------------------------------- what happens inside one bucket
class _Pieces:
    """The pieces of one bucket, in order of (document, start)."""

    def __init__(self, table: pa.Table, repeated: np.ndarray, hot: np.ndarray, span: int, k: int):
        """repeated: sorted anchors that occur more than once; hot: the flag of each."""
        width = span - k + 1
        keys, places, sizes, contents, digests = [], [], [], [], []
        self.row_base = np.zeros(table.num_rows + 1, np.int64)
        base = 0
        for w in tokenised(table["text"], PLAIN):
            h = w.hashes()
            self.row_base[w.first_row : w.first_row + w.n_rows + 1] = base + w.row_word
            kept, fps, least = winnow(h, w.row, k, span)
            at = np.searchsorted(repeated, fps)
            known = (repeated[np.minimum(at, len(repeated) - 1)] == fps) if len(repeated) else np.zeros(len(fps), bool)
            kept, fps, at = kept[known], fps[known], at[known]
            if len(kept):
                owns = np.zeros((len(kept), width), bool)  # windows of which this anchor is the rightmost minimum
                taken = np.zeros(len(least), bool)
                for back in range(width - 1, -1, -1):
                    start = kept - back
                    ok = np.flatnonzero((start >= 0) & (start < len(least)))
                    ok = ok[(least[start[ok]] == fps[ok]) & ~taken[start[ok]]]
                    owns[ok, back] = True
                    taken[start[ok]] = True
                some = owns.any(axis=1)
                kept, fps, at, owns = kept[some], fps[some], at[some], owns[some]
                first, last = kept - (width - 1 - np.argmax(owns[:, ::-1], axis=1)), kept - np.argmax(owns, axis=1)
                warm = ~hot[at]
                self._take(keys, places, sizes, contents, digests, fps[warm], first[warm], last[warm] - first[warm] + span, h, base)
                if (~warm).any():
                    n = (last - first + 1)[~warm]
                    starts = np.repeat(first[~warm], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                    starts = np.unique(starts)
                    self._take(keys, places, sizes, contents, digests, ngram_hashes(h, span)[starts], starts, np.full(len(starts), span), h, base)
            base += len(h)
        self.n_words = base
        cat = lambda x, t: np.concatenate([*x, np.zeros(0, t)])
        self.key, self.place, self.size = cat(keys, U64), cat(places, np.int64), cat(sizes, np.int64)
        digest = cat(digests, U64)
        # the first of equal pieces stands for them; numpy's unique keeps the first place of each value
        order = np.argsort(self.place, kind="stable")
        self.key, self.place, self.size, digest = self.key[order], self.place[order], self.size[order], digest[order]
        _, firsts = np.unique(digest ^ self.key, return_index=True)
        self.is_first = np.zeros(len(self.key), bool)
        self.is_first[firsts] = True
        self.contents, self.order = contents, order

    @staticmethod
    def _take(keys, places, sizes, contents, digests, key, first, size, h, base) -> None:
        if not len(key):
            return
        ends = np.cumsum(size)
        words = h[np.repeat(first - (ends - size), size) + np.arange(ends[-1])]
        marks = np.concatenate((np.zeros(1, U64), np.cumsum(words * (np.arange(len(words)) - np.repeat(ends - size, size) + 1).astype(U64) * U64(0xD6E8FEB86659FD93) ^ (words >> U64(32)))))
        keys.append(key)
        places.append(first + base)
        sizes.append(size)
        contents.append(words)
        digests.append((marks[ends] - marks[ends - size]) * U64(0x9E3779B97F4A7C15) + size.astype(U64))

    def words_of(self, chosen: np.ndarray) -> np.ndarray:
        words = np.concatenate([*self.contents, np.zeros(0, U64)])
        size = np.empty(len(self.order), np.int64)
        size[self.order] = self.size
        starts = (np.cumsum(size) - size)[self.order][chosen]
        n = self.size[chosen]
        ends = np.cumsum(n)
        return words[np.repeat(starts - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("order_null", "ascending"), ("order_id", "ascending"), ("order_text", "ascending")])


def _messages(table: pa.Table | None, kind: int) -> list[tuple[bytes, bytes]]:
    if table is None:
        return []
    return [(k, m) for n, k, m in zip(table["kind"].to_pylist(), table["keys"].to_pylist(), table["more"].to_pylist(), strict=True) if n == kind]


def _repeated(messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    got = _messages(messages, 0)
    keys = np.concatenate([*(np.frombuffer(k, U64) for k, _ in got), np.zeros(0, U64)])
    hot = np.concatenate([*(np.frombuffer(m, bool) for _, m in got), np.zeros(0, bool)])
    order = np.argsort(keys)
    return keys[order], hot[order]


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by shard, and where each shard begins."""
    shard = (keys % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _key_of(table: pa.Table) -> int:
    return table["bucket"][0].as_py()


# ---------------------------------------------------------------- the stages
def _anchors(shards: int, span: int, k: int):
    def scan(table: pa.Table) -> pa.Table:
        found = [winnow(w.hashes(), w.row, k, span)[1] for w in tokenised(table["text"], PLAIN)]
        keys, counts = np.unique(np.concatenate([*found, np.zeros(0, U64)]), return_counts=True)
        order, cut = _dealt(keys, shards)
        keys, counts = keys[order], np.minimum(counts[order], 65535).astype(np.uint16)
        some = np.flatnonzero(np.diff(cut))
        return pa.table({"bucket": pa.array(some, pa.int32()), "kind": pa.array(np.full(len(some), _key_of(table)), pa.int32()),
                         "keys": pa.array([keys[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary()),
                         "more": pa.array([counts[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary())})

    return scan


def _count(hot_from: int):
    def count(table: pa.Table) -> pa.Table:
        """Anchors of one shard: back to each bucket go those that occur more than once."""
        parts = [np.frombuffer(x, U64) for x in table["keys"].to_pylist()]
        keys, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate([np.frombuffer(x, np.uint16) for x in table["more"].to_pylist()]).astype(float))
        rows, at = [], 0
        for bucket, part in zip(table["kind"].to_pylist(), parts, strict=True):
            n = totals[inverse[at : at + len(part)]]
            at += len(part)
            if (n > 1).any():
                rows.append((bucket, 0, part[n > 1].tobytes(), (n[n > 1] > hot_from).tobytes()))
        return pa.table(dict(zip(("bucket", "kind", "keys", "more"), zip(*rows, strict=True) if rows else ([],) * 4, strict=True)), pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())]))

    return count


_PIECES = "shard int, bucket int, n int, ids binary, rows binary, keys binary, docs binary, places binary, sizes binary, words binary"


def _send(shards: int, span: int, k: int):
    def send(docs: pa.Table, messages: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _PIECES.split(", ")]
        rows = []
        if docs.num_rows and messages.num_rows:
            docs = _ordered(docs)
            pieces = _Pieces(docs, *_repeated(messages), span, k)
            chosen = np.flatnonzero(pieces.is_first)
            order, cut = _dealt(pieces.key[chosen], shards)
            chosen = chosen[order]
            words, sizes = pieces.words_of(chosen), pieces.size[chosen]
            ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
            row = np.searchsorted(pieces.row_base, pieces.place[chosen], "right") - 1
            ids, by_text = pc.fill_null(docs["order_id"], np.iinfo(np.int64).min).to_numpy()[row], docs["order_text"].to_numpy()[row]
            for s in np.flatnonzero(np.diff(cut)).tolist():
                a, b = cut[s], cut[s + 1]
                rows.append((s, _key_of(docs), int(b - a), chosen[a:b].astype(np.uint32).tobytes(), by_text[a:b].tobytes(), pieces.key[chosen[a:b]].tobytes(), ids[a:b].tobytes(),
                             (pieces.place[chosen[a:b]] - pieces.row_base[row[a:b]]).astype(np.uint32).tobytes(), sizes[a:b].astype(np.uint16).tobytes(), words[ends[a] : ends[b]].tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.table({n: pa.array(c, pa.int32() if n in ("shard", "bucket", "n") else pa.binary()) for n, c in zip(names, columns, strict=True)})

    return send


def _judge(span: int):
    def judge(table: pa.Table) -> pa.Table:
        """All pieces of one shard's anchors: which of their windows started earlier elsewhere."""
        get = lambda name, t: np.concatenate([np.frombuffer(x, t) for x in table[name].to_pylist()])
        bucket = np.repeat(table["bucket"].to_numpy(), table["n"].to_numpy())
        piece, row, key, doc, place, size, words = get("ids", np.uint32), get("rows", np.int64), get("keys", U64), get("docs", np.int64), get("places", np.uint32), get("sizes", np.uint16).astype(np.int64), get("words", U64)
        starts = np.cumsum(size) - size
        order = np.lexsort((place, row, doc, key))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key[order])) + 1, [len(order)]))
        verdict = np.zeros(len(key), U64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < 2:
                if size[order[a]] > span and _may_repeat(words[starts[order[a]] : starts[order[a]] + size[order[a]]]):
                    b = a + 1
                else:
                    continue
            automaton, seen = SuffixAutomaton(), set()
            for i in order[a:b].tolist():
                content = words[starts[i] : starts[i] + size[i]]
                windows = int(size[i]) - span + 1
                if (blob := content.tobytes()) in seen:
                    verdict[i] = (1 << windows) - 1
                    continue
                seen.add(blob)
                matched = automaton.add(content.tolist())
                verdict[i] = sum(1 << t for t in range(windows) if matched[t + span - 1] >= span)
        some = np.flatnonzero(verdict)
        some = some[np.argsort(bucket[some], kind="stable")]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(bucket[some])) + 1, [len(some)])) if len(some) else [0]
        rows = [(int(bucket[some[a]]), 1, piece[some[a:b]].tobytes(), verdict[some[a:b]].astype(U64).tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table(dict(zip(("bucket", "kind", "keys", "more"), zip(*rows, strict=True) if rows else ([],) * 4, strict=True)), pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())]))

    return judge


def _may_repeat(words: np.ndarray) -> bool:
    return len(np.unique(words)) < len(words)


def _remove(span: int, k: int, carry: list[str]):
    def remove(docs: pa.Table, messages: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        removed = np.zeros(0, bool)
        if docs.num_rows and messages.num_rows:
            pieces = _Pieces(docs, *_repeated(messages), span, k)
            masks = np.where(pieces.is_first, U64(0), (U64(1) << (pieces.size - span + 1).astype(U64)) - U64(1))
            for ids, verdict in _messages(messages, 1):
                masks[np.frombuffer(ids, np.uint32)] = np.frombuffer(verdict, U64)
            edge = np.zeros(pieces.n_words + 1, np.int64)
            for t in range(int(pieces.size.max()) - span + 1 if len(pieces.size) else 0):
                at = np.unique(pieces.place[(masks >> U64(t)) & U64(1) == 1] + t)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + span, -1)
            removed = np.cumsum(edge)[:-1] > 0
        n_words, n_removed, texts = _without(docs["text"], removed)
        out = {f"c{i}": docs[f"c{i}"] for i in range(len(carry))}
        return pa.table(out | {"n_words": n_words, "n_removed": n_removed, "kept_text": pa.array(texts, pa.string())})

    return remove


def _without(column, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word counts, removed counts and the kept words joined by one blank; removed may be empty."""
    n_words, n_removed, texts, base = [], [], [], 0
    for w in tokenised(column, PLAIN):
        gone = removed[base : base + len(w)] if len(removed) else np.zeros(len(w), bool)
        base += len(w)
        n_words.append(np.diff(w.row_word))
        n_removed.append(np.diff(np.concatenate(([0], np.cumsum(gone)))[w.row_word]))
        texts += _joined(w, ~gone)
    cat = lambda x: np.concatenate([*x, np.zeros(0, np.int64)])
    return cat(n_words), cat(n_removed), texts


def _joined(w: Words, keep: np.ndarray) -> list[str]:
    """Each row's kept words joined by one blank, byte-wise for all rows at once."""
    starts, ends = w.starts[keep], w.ends[keep]
    edge = np.zeros(len(w.data) + 1, np.int8)
    edge[starts] += 1
    np.add.at(edge, ends + 1, -1)  # the byte after each word becomes its blank; rows end in a blank
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = w.data.copy()
    data[ends] = 0x20
    kept = data[mask].tobytes()
    cut = np.concatenate(([0], np.cumsum(mask)))[w.row_byte]
    return [kept[a:b][:-1].decode() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, span: int = SPAN, k: int = K, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of docs: the carried columns (the id if none are named), n_words, n_removed, kept_text."""
    if span - k + 1 > 33 or k > span:
        raise ValueError("span - k must lie between 0 and 32")
    carry = [id_col] if carry is None else list(carry)
    buckets = bucket_count(text_bytes(docs, text_col), bucket_bytes)
    id_, text = whole_number_id(docs, id_col), F.coalesce(F.col(text_col), F.lit(""))
    bucket = F.pmod(F.xxhash64(id_, text), F.lit(buckets)).cast("int").alias("bucket")
    slim = docs.select(bucket, id_.isNotNull().alias("order_null"), id_.alias("order_id"), F.xxhash64(text).alias("order_text"), text.alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    # as many tasks as there are buckets: what a task reads does not grow with the table
    dealt = lambda df, key: df.repartition(buckets, key).groupBy(key)
    by_bucket = dealt(slim, "bucket")
    anchors = by_bucket.applyInArrow(frugal(_anchors(buckets, span, k)), _MESSAGE)
    repeated = dealt(anchors, "bucket").applyInArrow(frugal(_count(hot)), _MESSAGE)
    pieces = by_bucket.cogroup(dealt(repeated, "bucket")).applyInArrow(frugal(_send(buckets, span, k)), _PIECES)
    verdicts = dealt(pieces, "shard").applyInArrow(frugal(_judge(span)), _MESSAGE)
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    out = by_bucket.cogroup(dealt(repeated.unionByName(verdicts), "bucket")).applyInArrow(frugal(_remove(span, k, carry)), f"{types}{', ' if carry else ''}n_words long, n_removed long, kept_text string")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "n_words", "n_removed", "kept_text")


# ---------------------------------------------------------------- against a bounded reference
def reference_shards(reference: DataFrame, text_col: str = "text", *, max_words: int = 2_000_000, shard_words: int = 100_000) -> list[list[np.ndarray]]:
    """The words of a reference of at most max_words words, as shards of whole texts."""
    shards, n, total = [[]], 0, 0
    for (text,) in reference.select(text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        for w in tokenised(pa.array([text], pa.large_string()), PLAIN):
            total += len(w)
            if total > max_words:
                raise ValueError(f"the reference has more than {max_words} words: use dedup_substrings on documents and reference together")
            if n and n + len(w) > shard_words:
                shards.append([])
                n = 0
            shards[-1].append(w.hashes())
            n += len(w)
    return shards


def remove_reference_spans(docs: DataFrame, reference: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reference_text_col: str = "text", min_words: int = SPAN, **limits) -> DataFrame:
    """Per row of docs: its id, n_words, n_removed and kept_text, without every maximal span of at least
    min_words words that occurs in the reference."""
    held = [docs.sparkSession.sparkContext.broadcast(x) for x in reference_shards(reference, reference_text_col, **limits)]
    automata: dict[int, SuffixAutomaton] = {}

    def stream(batches):
        for i, shard in enumerate(held):
            if i not in automata:
                automata[i] = SuffixAutomaton()
                for words in shard.value:
                    automata[i].add(words.tolist())
        for batch in batches:
            gone = []
            for w in tokenised(batch.column(1), PLAIN):
                h, edge = w.hashes(), np.zeros(len(w) + 1, np.int64)
                for r in range(w.n_rows):
                    a, b = int(w.row_word[r]), int(w.row_word[r + 1])
                    row = h[a:b].tolist()
                    for automaton in automata.values():
                        n = np.array(automaton.matching_statistics(row), np.int64)
                        ends = np.flatnonzero(n >= min_words)
                        np.add.at(edge, a + ends - n[ends] + 1, 1)
                        np.add.at(edge, a + ends + 1, -1)
                gone.append(np.cumsum(edge)[:-1] > 0)
            n_words, n_removed, texts = _without(batch.column(1), np.concatenate([*gone, np.zeros(0, bool)]))
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "n_words": n_words, "n_removed": n_removed, "kept_text": pa.array(texts, pa.string())})

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = df.mapInArrow(stream, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)


