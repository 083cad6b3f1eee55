"""N-gram Jaccard join by vertical partitioning.

A document's set are its distinct word 3-grams.  All n-grams have one global order: rarer first (counts
come from a table of fixed size that every task adds to), then by hash.

1.  Equal sets are one class, represented by its smallest document.
2.  Two sets of Jaccard >= t share an n-gram among their first n - ceil(t n) + 1 (prefix filter).  These
    prefixes are dealt by n-gram, packed; every task sends each set once, so copies do not pile up.
3.  In each n-gram's group the set with most copies is paired with all others that the sizes and
    positions allow.  The global order is cut into fragments of equal weight; for each pair the overlap
    is counted per fragment, separately, and the counts are summed.  The links found form components.
4.  Group members that are still in different components are then paired with each other, and those
    pairs are counted in the same way.  Before pairs are counted, a signature of 512 parities per set
    drops those whose sets must differ too much.  So every other candidate pair is counted or already connected, no
    link between different texts is lost, and a group of near copies costs about one pair per member.
    Members that no link connects cost a pair each with each: they are dealt to cells of bounded size.

Defined results: doc_id is a whole number (other types are an error); words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words than 3 are one
shingle as a whole; wordless, empty and null texts have n_shingles 0 and are linked with nothing; rows
that share an id are one node with the links of each; a null id has a null component.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, checkpointed, forget_shuffles, frugal, text_bytes, whole_number_id
from .components import components
from .wordhash import PLAIN_LOWER, U64, mix64, ngram_hashes, same_row, tokenised

N, THRESHOLD, FRAGMENTS, SLICES, HOME_PARTNERS, REQUESTS = 3, (90, 100), 4, 16, 1000, 64
#: Bits of a set's signature.
PARITIES = 512
#: Tasks whose counters are added up first, members of an n-gram's group that one cell pairs with as many others, and
#: keys under which the members of a group are looked up.
PARTS, CELL, SALTS = 64, 1000, 16
MIN_BITS, MAX_BITS = 20, 26


# ---------------------------------------------------------------- sets
def shingle_sets(column, n: int):
    """(row, sorted distinct shingle hashes) of each row that has words."""
    for w in tokenised(column, PLAIN_LOWER):
        h = w.hashes()
        grams, ok = ngram_hashes(h, n), same_row(w.row, n)
        sizes = np.diff(w.row_word)
        row = w.row[: len(grams)][ok]
        grams = grams[ok]
        order = np.lexsort((grams, row))
        row, grams = row[order], grams[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
        row, grams = row[first], grams[first]
        cut = np.searchsorted(row, np.arange(w.n_rows + 1))
        for r in np.flatnonzero(sizes).tolist():
            if sizes[r] < n:
                a, b = int(w.row_word[r]), int(w.row_word[r + 1])
                yield w.first_row + r, ngram_hashes(h[a:b], b - a)
            else:
                yield w.first_row + r, grams[cut[r] : cut[r + 1]]


def set_hash(grams: np.ndarray) -> tuple[int, int]:
    """Two independent 63-bit hashes of a set."""
    hi, lo = mix64(grams).sum(dtype=U64), mix64(grams ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
    return int(hi >> U64(1)), int(lo >> U64(1))


def parities(grams: np.ndarray) -> np.ndarray:
    """PARITIES bits, each the parity of the number of n-grams that hash to it."""
    odd = np.bincount((mix64(grams ^ U64(0x3C3C3C3C3C3C3C3C)) % U64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SETS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("slice", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()), ("bits", pa.list_(pa.int64()))])


def _scan(n: int, bits: int):
    """Per row its set's size and hash; per task the counts of n-grams, each distinct set once."""

    def scan(batches):
        counts, seen = np.zeros(1 << bits, np.uint32), set()
        for batch in batches:
            size, hi, lo = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            signs = np.zeros((len(batch), PARITIES // 64), np.int64)
            for r, grams in shingle_sets(batch.column("text"), n):
                size[r] = len(grams)
                hi[r], lo[r] = key = set_hash(grams)
                signs[r] = parities(grams)
                if key not in seen:
                    seen.add(key)
                    np.add.at(counts, (grams >> U64(64 - bits)).astype(np.int64), 1)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n": size, "hi": hi, "lo": lo, "slice": pa.nulls(len(batch), pa.int32()), "part": pa.nulls(len(batch), pa.int32()), "counts": pa.nulls(len(batch), pa.binary()), "bits": pa.array(list(signs), pa.list_(pa.int64()))}, schema=_SETS)
        if seen:
            nulls = pa.nulls(SLICES, pa.int64())
            blobs = [zlib.compress(c.tobytes(), 1) for c in np.split(counts, SLICES)]
            part = pa.array([TaskContext.get().partitionId() // PARTS] * SLICES, pa.int32())
            yield pa.RecordBatch.from_arrays([nulls, nulls, nulls, nulls, pa.array(range(SLICES), pa.int32()), part, pa.array(blobs, pa.binary()), pa.nulls(SLICES, pa.list_(pa.int64()))], schema=_SETS)

    return scan


def _counters(table: pa.Table) -> np.ndarray:
    total = np.zeros(0, np.int64)
    for blob in table["counts"]:
        counts = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
        total = total + counts if len(total) else counts.astype(np.int64)
    return total


def _sum_parts(table: pa.Table) -> pa.Table:
    """One slice of the counters of PARTS tasks; what does not fit stays at the largest number."""
    total = np.minimum(_counters(table), (1 << 32) - 1).astype(np.uint32)
    return pa.table({"slice": table["slice"][:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _sum_counts(table: pa.Table) -> pa.Table:
    total = _counters(table)
    ranks = np.minimum(255, np.round(8 * np.log2(total + 1)))
    return pa.table({"slice": table["slice"][:1], "ranks": [ranks.astype(np.uint8).tobytes()], "weights": [np.bincount(ranks.astype(np.int64), total, 256).astype(np.int64).tobytes()]})


class Order:
    """The global order of n-grams: by rank of their count, then by hash."""

    def __init__(self, ranks: np.ndarray, weights: np.ndarray, fragments: int):
        self.ranks, self.bits = ranks, len(ranks).bit_length() - 1
        share = np.cumsum(weights) / max(1, weights.sum())
        cuts = []
        for i in range(1, fragments):
            r = min(int(np.searchsorted(share, i / fragments)), len(share) - 1)
            before = share[r - 1] if r else 0.0
            within = min(1.0, max(0.0, (i / fragments - before) / max(share[r] - before, 1e-12)))
            cuts.append((r << 56) | int(within * ((1 << 56) - 1)))
        self.cuts = np.array(cuts, U64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        return (self.ranks[(grams >> U64(64 - self.bits)).astype(np.int64)].astype(U64) << U64(56)) | (mix64(grams) >> U64(8))


# ---------------------------------------------------------------- candidates
_POSTINGS = "shard int, tokens binary, ids binary, sets binary, sizes binary, places binary, copies binary"


def _prefixes(n: int, held, shards: int, up: int, down: int):
    def prefixes(batches):
        parts, seen, flushed = [], {}, 0

        def packed():
            cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
            shard = (cols[0] % U64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            some = np.flatnonzero(np.diff(cut))
            cols = [c[order] for c in cols]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array([c[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary()) for c in cols)], names=[x.split()[0] for x in _POSTINGS.split(", ")])

        for batch in batches:
            ids = batch.column("id").to_numpy()
            for r, grams in shingle_sets(batch.column("text"), n):
                key = set_hash(grams)
                if key in seen:  # a copy within this task: its smallest id and its number are kept
                    seen[key][0] = min(seen[key][0], int(ids[r]))
                    seen[key][1] += 1
                    continue
                size = len(grams)
                tokens = np.sort(held.value.keys(grams))[: size - -(-up * size // down) + 1]
                seen[key] = [int(ids[r]), 1, tokens, size]
            if len(seen) - flushed > 20_000:  # bounds the memory; later copies start anew
                parts = [_posting(k, v) for k, v in seen.items()]
                yield packed()
                seen = {}
        if seen:
            parts = [_posting(k, v) for k, v in seen.items()]
            yield packed()

    return prefixes


def _posting(key: tuple[int, int], value: list) -> tuple[np.ndarray, ...]:
    id_, copies, tokens, size = value
    m = len(tokens)
    return tokens, np.full(m, id_, np.int64), np.full(m, key[1], np.int64), np.full(m, size, np.uint32), np.arange(m, dtype=np.uint32), np.full(m, copies, np.uint32)


_FOUND = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("a", "a_set", "a_n", "b", "b_set", "b_n", "token"))])


def _possible(nx, px, ny, py, up: int, down: int):
    """Whether sizes and positions of a common n-gram allow the overlap that the threshold needs."""
    need = -(-up * (nx + ny) // (up + down))
    return np.minimum(nx - px, ny - py) >= need


def _groups(table: pa.Table):
    """Postings of one shard, copies of a set merged, as arrays sorted by token; leaders first."""
    get = lambda name, t: np.concatenate([np.frombuffer(x, t) for x in table[name].to_pylist()])
    token, id_, set_, size, place, copies = get("tokens", U64), get("ids", np.int64), get("sets", np.int64), get("sizes", np.uint32).astype(np.int64), get("places", np.uint32).astype(np.int64), get("copies", np.uint32).astype(np.int64)
    order = np.lexsort((id_, set_, token))
    token, id_, set_, size, place, copies = (x[order] for x in (token, id_, set_, size, place, copies))
    first = np.ones(len(token), bool)
    first[1:] = (token[1:] != token[:-1]) | (set_[1:] != set_[:-1])
    at = np.flatnonzero(first)
    copies = np.add.reduceat(copies, at) if len(at) else copies
    token, id_, set_, size, place = (x[at] for x in (token, id_, set_, size, place))
    order = np.lexsort((id_, -copies, token))
    return tuple(x[order] for x in (token, id_, set_, size, place))


def _pair(up: int, down: int):
    def pair(table: pa.Table) -> pa.Table:
        token, id_, set_, size, place = _groups(table)
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        members = np.diff(np.append(start, len(token)))
        leader = np.repeat(start, members)
        many = np.repeat(members, members) > 2
        other = np.flatnonzero((leader != np.arange(len(token))))
        head = leader[other]
        ok = _possible(size[head], place[head], size[other], place[other], up, down)
        a, b = head[ok], other[ok]  # the leader is the home, whatever its id: its partners are dealt by salt
        _, once = np.unique(np.stack((id_[a], set_[a], id_[b], set_[b])), axis=1, return_index=True) if len(a) else (None, np.zeros(0, np.int64))
        a, b = a[once], b[once]
        m = np.flatnonzero(many)
        zero = np.zeros(len(a), np.int64)
        return pa.table([np.concatenate((zero, np.ones(len(m), np.int64))).astype(np.int32), np.concatenate((id_[a], id_[m])), np.concatenate((set_[a], set_[m])), np.concatenate((size[a], size[m])), np.concatenate((id_[b], place[m])),
                         np.concatenate((set_[b], np.zeros(len(m), np.int64))), np.concatenate((size[b], np.zeros(len(m), np.int64))), np.concatenate((zero, token[m].astype(np.int64)))], schema=_FOUND)

    return pair


def _cross(up: int, down: int):
    """Members of one group that lie in different components: the pairs that sizes and positions allow.

    A cell holds the members of two parts of a group (of one, if they are the same)."""

    def cross(table: pa.Table) -> pa.Table:
        token, x, y, a, s, n, p, comp, part = (table[c].to_numpy() for c in ("token", "x", "y", "a", "a_set", "a_n", "b", "component", "part"))
        order = np.lexsort((s, a, y, x, token))
        token, x, y, a, s, n, p, comp, part = (c[order] for c in (token, x, y, a, s, n, p, comp, part))
        cut = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]), [True])))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if (comp[lo:hi] == comp[lo]).all():
                continue
            left, right = (np.flatnonzero(part[lo:hi] == k[lo]) + lo for k in (x, y))
            for k, i in enumerate(left.tolist()):
                others = right[k + 1 :] if x[lo] == y[lo] else right
                j = others[(comp[others] != comp[i]) & _possible(n[i], p[i], n[others], p[others], up, down)]
                found.append((np.full(len(j), i), j))
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        swap = (a[i] > a[j]) | ((a[i] == a[j]) & (s[i] > s[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return pa.table({"a": a[i], "a_set": s[i], "a_n": n[i], "b": a[j], "b_set": s[j], "b_n": n[j]})

    return cross


def _cells(members: DataFrame, shards: int) -> DataFrame:
    """Members of the n-gram groups that span several components, by shard.

    A group is dealt to parts of about CELL members, which are repeated for every pair of parts (x <= y) that
    theirs belongs to; each pair of a large group is a shard of its own, small groups share shards.  Members find
    their group's size under SALTS keys, so a frequent n-gram is many rows of each of them, not all of one."""
    stats = members.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    stats = stats.where("least <> most").select("token", "parts", salts)
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("a", "a_set"), F.lit(SALTS)).cast("int")).join(stats, ["token", "salt"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("a_set", "a"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"x": F.least("part", "other"), "y": F.greatest("part", "other")})
    own = F.lit(shards) + F.pmod(F.xxhash64("token", "x", "y"), F.lit(1 << 40))
    return dealt.withColumn("shard", F.when(F.col("parts") > 1, own).otherwise(F.pmod(F.xxhash64("token"), F.lit(shards)))).drop("other", "parts", "salt")


def _plausible(pairs: DataFrame, signatures: DataFrame, up: int, down: int) -> DataFrame:
    """The pairs that their signatures allow: signatures differ in no more bits than the sets differ in n-grams,
    and the threshold bounds that number.  Nothing that reaches the threshold is lost."""
    side = lambda x: signatures.select(F.col("id").alias(x), F.col("lo").alias(f"{x}_set"), F.col("bits").alias(f"{x}_bits"))
    both = pairs.join(side("a"), ["a", "a_set"]).join(side("b"), ["b", "b_set"])
    differ = F.aggregate(F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return both.where(differ * (up + down) <= (F.col("a_n") + F.col("b_n")) * (down - up)).select(*pairs.columns)


# ---------------------------------------------------------------- counting
_SEGMENTS = pa.schema([("shard", pa.int32()), ("fragment", pa.int32()), ("home", pa.int64()), ("home_set", pa.int64()), ("salt", pa.int64()), ("doc", pa.int64()), ("doc_set", pa.int64()), ("segment", pa.binary())])


def _cut(n: int, held, shards: int):
    """Each requested set, cut into its fragments, one row per home that asked and fragment."""

    def packed(rows):
        columns = list(zip(*rows, strict=True)) or [()] * len(_SEGMENTS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SEGMENTS.types, strict=True)], schema=_SEGMENTS)

    def cut(batches):
        for batch in batches:
            ids, asked, rows, size = batch.column("id").to_pylist(), batch.column("asked"), [], 0
            for r, grams in shingle_sets(batch.column("text"), n):
                lo = set_hash(grams)[1]
                wanted = [x for x in asked[r].as_py() if x["doc_set"] == lo]
                if not wanted:
                    continue
                keys = np.sort(held.value.keys(grams))
                at = [0, *np.searchsorted(keys, held.value.cuts).tolist(), len(keys)]
                blobs = [keys[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
                for x in wanted:
                    shard = (x["home"] * 31 + x["salt"]) % shards
                    rows += [(shard, f, x["home"], x["home_set"], x["salt"], ids[r], lo, blob) for f, blob in enumerate(blobs)]
                    size += keys.nbytes
                    if size > 8 << 20:
                        yield packed(rows)
                        rows, size = [], 0
            yield packed(rows)

    return cut


def _overlap(table: pa.Table) -> pa.Table:
    """Partial overlaps of one fragment: every partner's segment with its home's."""
    homes, rows = {}, table.select(["home", "home_set", "salt", "doc", "doc_set", "segment"]).to_pydict()
    rows = list(zip(*rows.values(), strict=True))
    for home, home_set, salt, doc, doc_set, segment in rows:
        if (doc, doc_set) == (home, home_set):
            homes[home, home_set, salt] = np.frombuffer(segment, U64)
    out = {}
    for home, home_set, salt, doc, doc_set, segment in rows:
        if (doc, doc_set) != (home, home_set):
            x, y = homes[home, home_set, salt], np.frombuffer(segment, U64)
            at = np.searchsorted(x, y)
            out[home, home_set, doc, doc_set] = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
    keys = list(zip(*out, strict=True)) or [()] * 4
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("home", "home_set", "doc", "doc_set", "overlap"), [*keys, list(out.values())], strict=True)})


def _links(texts: DataFrame, pairs: DataFrame, n: int, held, shards: int, up: int, down: int) -> DataFrame:
    """The pairs (a, a_set, a_n, b, b_set, b_n) that reach the threshold: u, v."""
    asks = pairs.groupBy("a", "a_set").agg(F.count("*").alias("partners"))
    asks = asks.withColumn("salts", F.ceil(F.col("partners") / HOME_PARTNERS).cast("long"))
    salted = pairs.join(asks, ["a", "a_set"]).withColumn("salt", F.pmod(F.xxhash64("b", "b_set"), F.col("salts")))
    homes = asks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    request = F.struct(F.col("doc_set"), F.col("a").alias("home"), F.col("a_set").alias("home_set"), F.col("salt"))
    wanted = salted.select(F.col("b").alias("id"), F.col("b_set").alias("doc_set"), "a", "a_set", "salt").union(homes.select(F.col("a").alias("id"), F.col("a_set").alias("doc_set"), "a", "a_set", "salt"))
    # a set that very many homes ask for is looked up under SALTS keys; most ids need no more than one row
    parts = wanted.groupBy("id").agg(F.ceil(F.count("*") / REQUESTS).cast("long").alias("parts")).where("parts > 1")
    parts = parts.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    spread = F.xxhash64("doc_set", "a", "a_set", "salt")
    wanted = wanted.withColumn("key", F.pmod(spread, F.lit(SALTS))).join(parts, ["id", "key"], "left")
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("a_set", "a", "salt", "doc_set"), F.coalesce("parts", F.lit(1).cast("long"))))
    wanted = wanted.groupBy("id", "part").agg(F.collect_set(request).alias("asked"))  # about REQUESTS a row
    asked = texts.join(wanted.hint("shuffle_hash"), "id").select("id", "text", "asked")
    segments = asked.mapInArrow(frugal(_cut(n, held, shards)), "shard int, fragment int, home long, home_set long, salt long, doc long, doc_set long, segment binary")
    partial = segments.groupBy("shard", "fragment").applyInArrow(_overlap, "home long, home_set long, doc long, doc_set long, overlap long")
    total = partial.groupBy(F.col("home").alias("a"), F.col("home_set").alias("a_set"), F.col("doc").alias("b"), F.col("doc_set").alias("b_set")).agg(F.sum("overlap").alias("both"))
    judged = total.join(pairs, ["a", "a_set", "b", "b_set"]).where(F.col("both") * (up + down) >= (F.col("a_n") + F.col("b_n")) * up)
    return judged.select(F.col("a").alias("u"), F.col("b").alias("v"))


# ---------------------------------------------------------------- the operator
def near_duplicate_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: tuple[int, int] = THRESHOLD, fragments: int = FRAGMENTS, shard_bytes: int = 8 << 20) -> DataFrame:
    """Per row of docs: its id, n_shingles, component_id."""
    up, down = threshold
    sc = docs.sparkSession.sparkContext
    size = text_bytes(docs, text_col)
    shards = bucket_count(size, shard_bytes)
    bits = min(MAX_BITS, max(MIN_BITS, (size >> 10).bit_length()))
    rows = docs.select(whole_number_id(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.where("id IS NOT NULL AND text IS NOT NULL")

    scanned = checkpointed(rows.mapInArrow(frugal(_scan(n, bits)), "id long, n long, hi long, lo long, slice int, part int, counts binary, bits array<long>"))
    sets = scanned.where("slice IS NULL").select("id", "n", "hi", "lo")
    parts = scanned.where("slice IS NOT NULL").groupBy("slice", "part").applyInArrow(_sum_parts, "slice int, counts binary")
    summed = parts.groupBy("slice").applyInArrow(_sum_counts, "slice int, ranks binary, weights binary").orderBy("slice").collect()
    ranks = np.concatenate([np.frombuffer(r.ranks, np.uint8) for r in summed]) if summed else np.zeros(1 << bits, np.uint8)
    weights = sum((np.frombuffer(r.weights, np.int64) for r in summed), np.zeros(256, np.int64))
    held = sc.broadcast(Order(ranks, weights, fragments))

    postings = texts.mapInArrow(frugal(_prefixes(n, held, shards, up, down)), _POSTINGS)
    found = checkpointed(postings.groupBy("shard").applyInArrow(frugal(_pair(up, down)), "kind int, a long, a_set long, a_n long, b long, b_set long, b_n long, token long"))
    forget_shuffles(docs.sparkSession)  # of the postings, which are paired and written
    pair_columns = ["a", "a_set", "a_n", "b", "b_set", "b_n"]
    usable = sets.where("n > 0 AND id IS NOT NULL")
    signatures = scanned.where("slice IS NULL AND n > 0 AND id IS NOT NULL").groupBy("id", "lo").agg(F.first("bits").alias("bits"))  # equal for equal sets
    pairs = found.where("kind = 0").select(*pair_columns).distinct()
    classes = usable.groupBy("hi", "lo").agg(F.min("id").alias("rep"))
    # an id that stands on rows with different texts links their classes
    several = usable.groupBy("id").agg(F.min("hi").alias("x"), F.max("hi").alias("y")).where("x <> y").select("id")
    bridges = usable.join(several, "id").join(classes, ["hi", "lo"]).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    asked = checkpointed(_plausible(pairs, signatures, up, down))
    links = checkpointed(_links(texts, asked, n, held, shards, up, down).union(bridges))
    forget_shuffles(docs.sparkSession)  # of the segments
    joined = components(links)

    members = found.where("kind = 1").join(joined, F.col("a") == F.col("node"), "left").withColumn("component", F.coalesce("component", "a"))
    members = members.select("token", "a", "a_set", "a_n", "b", "component")
    cells = _cells(members, shards).repartition(shards, "shard")
    rest = cells.groupBy("shard").applyInArrow(frugal(_cross(up, down)), ", ".join(f"{c} long" for c in pair_columns)).distinct()
    rest = checkpointed(rest.join(pairs.select("a", "a_set", "b", "b_set").union(pairs.select("b", "b_set", "a", "a_set")), ["a", "a_set", "b", "b_set"], "left_anti").select(*pair_columns))
    rest = checkpointed(_plausible(rest, signatures, up, down))
    if not rest.isEmpty():
        more = checkpointed(_links(texts, rest, n, held, shards, up, down))
        forget_shuffles(docs.sparkSession)
        if not more.isEmpty():
            joined = components(links.union(more))

    labelled = classes.join(joined, F.col("rep") == F.col("node"), "left").select("hi", "lo", F.coalesce("component", "rep").alias("component"))
    ids = usable.join(labelled, ["hi", "lo"]).groupBy("id").agg(F.min("component").alias("component"))
    out = sets.join(ids, "id", "left")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_one_each(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, all columns, whose id is the smallest of its component; of rows that share this id the
    one whose columns hash lowest.  Rows without an id can't be told apart and stay."""
    labelled = near_duplicate_components(docs, id_col=id_col, **options)
    same = labelled.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col("component_id") != F.col(id_col)).alias("_gone"), (F.count("*") > 1).alias("_many"))
    marks = checkpointed(same.where("_gone OR _many"))
    rows = docs.select(F.col(id_col).alias("id"), F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"))
    joined = rows.join(marks.hint("shuffle_hash"), F.col("id") == F.col("_id"), "left")
    columns = [F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)]
    kept = joined.where("_id IS NULL").select(*columns)
    if marks.where("_many AND NOT _gone").isEmpty():
        return kept
    first = joined.where("_many AND NOT _gone").groupBy("_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.union(first.select(*columns))
