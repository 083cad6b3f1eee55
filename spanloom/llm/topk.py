"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors become integers.  Every dimension is a term; ranges of documents form blocks that keep, per term,
their largest and smallest value and a forward index (the block's matrix).  For a query the sum over its
terms of the best value a block can contribute bounds every score of that block.  Documents are ordered by
the signs of a few projections and then by vec_id, so that a block's vectors resemble each other where the
table has clusters; queries are packed into batches in the same order.

1.  The bounds of all blocks are taken from their term maxima alone; each query's ``seeds`` blocks of highest
    bound are scored, which gives it a first k-th score.
2.  With these thresholds the bounds are taken again: a block travels only to the batches in which it can
    still reach the k-th score of some query.
3.  Batches meet their blocks in cells of bounded size; there each query scores blocks in the order of their
    bounds until the bound falls below its k-th score.  A cell returns at most k rows per query, and the k
    best per query are kept.

Nothing is estimated: bounds, scores and ties (smaller vec_id) are exact integers.

Defined results: vec_id is a whole number (other types are an error); vectors null, empty or with null or
non-finite components, and rows without vec_id, take no part; shorter vectors count as padded by zeros; rows
that share a query's vec_id count as its own; of rows that share a vec_id divisible by ``every`` the smallest
vector asks; a query with fewer candidates gets them all; other columns are ignored.  Scores must fit a
64-bit integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, whole_number_id
from .wordhash import U64, mix64

BLOCK, SLICE_BLOCKS, BATCH, SEEDS, CODE_BITS = 256, 16, 5000, 2, 12
#: Blocks whose term maxima are looked at in one cell.
SUMMARIES = 4096
LEAST = np.iinfo(np.int64).min


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * x) of each usable vector."""
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.where(usable).select(whole_number_id(table, id_col).alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def _code(batches):
    """vectors + code: the signs of CODE_BITS projections, the same in every task."""
    for batch in batches:
        m = _matrix(batch.column("v")).astype(np.float64)
        cells = np.arange(m.shape[1] * CODE_BITS, dtype=np.uint64).reshape(-1, CODE_BITS)
        signs = np.where(mix64(cells + U64(1)) >> U64(63), 1.0, -1.0)
        code = ((m @ signs > 0) << np.arange(CODE_BITS)).sum(axis=1)
        yield batch.append_column("code", pa.array(code.astype(np.int32)))


def _narrow(m: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if np.abs(m).max(initial=0) <= np.iinfo(kind).max:
            return m.astype(kind)
    return m


_PACKED = "part int, block long, ids binary, width int, kind string, matrix binary, top binary, low binary"


def _pack(rows_each: int):
    """Rows in runs of rows_each, with the largest and smallest value per term; part is the task."""

    def pack(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, m = batch.column("vec_id").to_numpy(), _narrow(_matrix(batch.column("v")))
            for a in range(0, len(ids), rows_each):
                x = m[a : a + rows_each]
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": [(part << 32) + n], "ids": [ids[a : a + rows_each].tobytes()], "width": pa.array([m.shape[1]], pa.int32()), "kind": [m.dtype.str], "matrix": [x.tobytes()], "top": [x.max(axis=0).tobytes()], "low": [x.min(axis=0).tobytes()]})
                n += 1

    return pack


def _packed(df: DataFrame, tasks: int, rows_each: int) -> DataFrame:
    ordered = df.mapInArrow(_code, "vec_id long, v array<long>, code int").repartitionByRange(tasks, "code", "vec_id").sortWithinPartitions("code", "vec_id")
    return checkpointed(ordered.mapInArrow(_pack(rows_each), _PACKED))  # one order for all that follows


def _unpacked(table: pa.Table, *columns: str) -> list[tuple[np.ndarray, ...]]:
    """Of each row the given columns as matrices of one width for all rows."""
    width = max(table["width"].to_pylist(), default=0)
    out = []
    for row in table.select(["width", "kind", *columns]).to_pylist():
        parts = (np.frombuffer(row[c], row["kind"]).reshape(-1, row["width"]) for c in columns)
        out.append(tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in parts))
    return out


def _ids(table: pa.Table, column: str = "ids") -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in table[column].to_pylist())])


def _widened(*groups: list[np.ndarray]) -> list[list[np.ndarray]]:
    """All matrices with one width and one number type, in which no sum of products is rounded."""
    width = max((m.shape[1] for g in groups for m in g), default=0)
    most = [max((int(np.abs(m.astype(object)).max(initial=0)) for m in g), default=0) for g in groups]
    number = np.float64 if most[0] * max(most[1:], default=0) * width < 2**52 else np.int64
    return [[np.pad(m.astype(number), ((0, 0), (0, width - m.shape[1]))) for m in g] for g in groups]


def _bounds(queries: pa.Table, blocks: pa.Table) -> np.ndarray:
    """Queries x blocks: no score of the block is higher."""
    sums = _unpacked(blocks, "top", "low")
    q, top, low = _widened([m for (m,) in _unpacked(queries, "matrix")], [t for t, _ in sums], [x for _, x in sums])
    q, top, low = np.concatenate(q), np.concatenate(top), np.concatenate(low)
    return np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T


def _best_blocks(seeds: int):
    def best(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        if not len(queries) or not len(blocks):
            return pa.table({"query_id": pa.array([], pa.int64()), "batch": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "bound": pa.array([], pa.float64())})
        bounds, names, ids = _bounds(queries, blocks), blocks["block"].to_numpy(), _ids(queries)
        n = min(seeds, len(names))
        at = np.argpartition(-bounds, n - 1, axis=1)[:, :n]
        return pa.table({"query_id": np.repeat(ids, n), "batch": pa.array(np.full(n * len(ids), queries["batch"][0].as_py()), pa.int32()), "block": names[at].ravel(), "bound": np.take_along_axis(bounds, at, 1).ravel().astype(np.float64)})

    return best


def _reaching(queries: pa.Table, blocks: pa.Table) -> pa.Table:
    """Blocks that can reach the k-th score of some query of the batch, and how many queries that is."""
    if not len(queries) or not len(blocks):
        return pa.table({"batch": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "asking": pa.array([], pa.int64())})
    asking = (_bounds(queries, blocks) >= _ids(queries, "kth")[:, None]).sum(axis=0)
    some = asking > 0
    names = blocks["block"].to_numpy()[some]
    return pa.table({"batch": pa.array(np.full(len(names), queries["batch"][0].as_py()), pa.int32()), "block": names, "asking": asking[some].astype(np.int64)})


_RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def search_cell(queries: tuple, blocks: list, k: int, kth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top k of each query among the blocks of one cell: query ids, vec ids, scores; kth: what to reach."""
    q_ids, q = queries
    (q,), mats = _widened([q], [m for _, m in blocks])
    number = q.dtype.type
    order = np.argsort([i.min() for i, _ in blocks], kind="stable").tolist()
    blocks = [(blocks[b][0], mats[b]) for b in order]
    top, low = np.stack([m.max(axis=0) for _, m in blocks]), np.stack([m.min(axis=0) for _, m in blocks])
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(q), LEAST) if kth is None else kth
    kth = np.where(kth == LEAST, -np.inf, kth) if number is np.float64 else kth.copy()
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, number))]
    active = np.arange(len(q))
    for turn in range(len(blocks)):
        mine = order[active, turn]
        going = bounds[active, mine] >= kth[active]
        active, mine = active[going], mine[going]
        if not len(active):
            break
        for b in np.unique(mine).tolist():
            asks = active[mine == b]
            ids, m = blocks[b]
            scores = q[asks] @ m.T
            at, col = np.nonzero((scores >= kth[asks][:, None]) & (ids[None, :] != q_ids[asks][:, None]))
            found.append((asks[at], ids[col], scores[at, col]))
        row, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
        best = np.lexsort((vec, -score, row))
        row, vec, score = row[best], vec[best], score[best]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row]
        keep, last = rank < k, rank == k - 1
        kth[row[last]] = np.maximum(kth[row[last]], score[last])
        found = [(row[keep], vec[keep], score[keep])]
    row, vec, score = found[0]
    return q_ids[row], vec, score.astype(np.int64)


def _cell(k: int):
    def cell(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        if not len(queries) or not len(blocks):
            return _RESULT.empty_table()
        width = max(queries["width"].to_pylist())
        q = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for (m,) in _unpacked(queries, "matrix")])
        parts = [(np.frombuffer(i, np.int64), m) for i, (m,) in zip(blocks["ids"].to_pylist(), _unpacked(blocks, "matrix"), strict=True)]
        return pa.table(dict(zip(_RESULT.names, search_cell((_ids(queries), q), parts, k, _ids(queries, "kth")), strict=True)), schema=_RESULT)

    return cell


def _seed_cell(k: int):
    def cell(asks: pa.Table, blocks: pa.Table) -> pa.Table:
        if not len(asks) or not len(blocks):
            return _RESULT.empty_table()
        parts = [(np.frombuffer(i, np.int64), m) for i, (m,) in zip(blocks["ids"].to_pylist(), _unpacked(blocks, "matrix"), strict=True)]
        found = search_cell((asks["query_id"].to_numpy(), _matrix(asks["v"].combine_chunks())), parts, k)
        return pa.table(dict(zip(_RESULT.names, found, strict=True)), schema=_RESULT)

    return cell


def _best(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def _with_kth(queries: pa.Table, scores: pa.Table) -> pa.Table:
    """Packed queries + the score that each has to reach."""
    known = dict(zip(scores["query_id"].to_pylist(), scores["kth"].to_pylist(), strict=True))
    kth = [np.array([known.get(i, LEAST) for i in np.frombuffer(ids, np.int64).tolist()], np.int64).tobytes() for ids in queries["ids"].to_pylist()]
    return queries.append_column("kth", pa.array(kth, pa.binary()))


def plan(vectors: DataFrame, queries: DataFrame, k: int, *, block: int = BLOCK, slice_blocks: int = SLICE_BLOCKS, batch: int = BATCH, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The packed blocks, the packed queries with their thresholds, and reaching(batch, block, asking): which
    blocks can still reach the k-th score of a query of a batch."""
    n, nq = vectors.count(), queries.count()
    batches = max(1, -(-nq // batch))
    blocks = _packed(vectors, max(1, -(-n // (block * slice_blocks))), block)
    asked = _packed(queries, batches, batch).withColumnRenamed("part", "batch").drop("block", "top", "low")
    groups = max(1, -(-n // (block * SUMMARIES)))
    summaries = blocks.select("block", "width", "kind", "top", "low", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    summaries = summaries.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    each = lambda df: df.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))).groupBy("batch", "group")

    near = each(asked).cogroup(summaries.groupBy("batch", "group")).applyInArrow(_best_blocks(seeds), "query_id long, batch int, block long, bound double")
    first = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block"))
    near = near.withColumn("n", first).where(F.col("n") <= seeds).select("query_id", "batch", "block")
    asks = near.join(queries.select(F.col("vec_id").alias("query_id"), "v"), "query_id")
    wanted = blocks.drop("part", "top", "low").join(near.select(F.col("batch").alias("batch"), F.col("block").alias("block")).distinct(), "block")
    hits = asks.groupBy("batch", "block").cogroup(wanted.groupBy("batch", "block")).applyInArrow(_seed_cell(k), "query_id long, vec_id long, score long")
    kth = _best(hits, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
    kth = near.select("query_id", "batch").distinct().join(kth, "query_id").select("batch", "query_id", "kth")
    asked = checkpointed(asked.groupBy("batch").cogroup(kth.groupBy("batch")).applyInArrow(_with_kth, "batch int, ids binary, width int, kind string, matrix binary, kth binary"))
    reaching = each(asked).cogroup(summaries.groupBy("batch", "group")).applyInArrow(_reaching, "batch int, block long, asking long")
    return blocks.drop("top", "low"), asked, reaching


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, *, slice_blocks: int = SLICE_BLOCKS, block: int = BLOCK, **sizes) -> DataFrame:
    """vectors(vec_id, v), queries(vec_id, v) -> query_id, rank, vec_id, score."""
    blocks, asked, reaching = plan(vectors, queries, k, block=block, slice_blocks=slice_blocks, **sizes)
    travelling = blocks.withColumn("slice", F.col("part")).join(reaching.select("batch", "block"), "block")
    cells = checkpointed(travelling.select("batch", "slice").distinct()).select(F.col("batch").alias("batch"), F.col("slice").alias("slice"))
    meeting = asked.join(cells, "batch").groupBy("batch", "slice").cogroup(travelling.groupBy("batch", "slice"))
    return _best(meeting.applyInArrow(_cell(k), "query_id long, vec_id long, score long"), k).select("query_id", "rank", "vec_id", "score")


def self_search(table: DataFrame, k: int = 20, every: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding", **sizes) -> DataFrame:
    """Rows whose id is divisible by ``every`` ask for the k best of all other rows."""
    vectors = integer_vectors(table, id_col, vector_col)
    asks = vectors.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    return top_k(vectors, asks, k, **sizes)
