"""Mixing sources to target weights.

Tokens are summed per source; the targets follow from the weights by water-filling (a source is filled
up to ``max_repeat`` times its size and its excess is shared again by weight); target / size is the
source's repetition rate, and each document is emitted floor(rate) times plus once more if a draw
seeded by its id falls below the fraction.  The draw is a hash, so reruns and retried tasks agree.

Documents are never shuffled: sizes are pre-aggregated per source in every task, and the target table
(one row per source) is joined back as a broadcast when it has at most ``broadcast_sources`` rows, as an
ordinary join beyond that.

Defined results: null text has size 0; a null source is a source of its own, last in order; rows that
share an id share their draw; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import plain_word_count

WEIGHTS, SHARE, MAX_REPEAT, SEED = (3, 1, 2), (3, 2), 2, "mix"


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sizes(source, size) -> source, source_size, target.

    Sources in order (null last) have the given weights, repeating; the targets sum to share[0]/share[1]
    of all sizes, or to max_repeat times the sizes if that is less.  Integer arithmetic decides which
    sources are full; one division gives the level of the others: the
    first source in order of filling that the remaining level does not fill (later ones give lower levels).
    """
    up, down = share
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * max_repeat).withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    w = w.withColumn("rest", F.col("total") * up - before * down).withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)) * down)
    level = F.when(F.col("cap") * F.col("open") >= F.col("weight") * F.col("rest"), F.col("rest") / F.col("open"))
    w = w.withColumn("level", F.max(level).over(Window.partitionBy()))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return w.select("source", "source_size", target.alias("target"))


def draw(id_: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: Sequence[str] = (), seed: str = SEED, broadcast_sources: int = 10_000, **targets) -> DataFrame:
    """Per row of docs: _id, the columns of keep as _k0, _k1, ..., _size, _source_size, _target and _copies."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), plain_word_count(text_col).alias("size"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)))
    table = source_targets(slim.select("source", "size"), **targets)
    rows = table.limit(broadcast_sources + 1).collect()
    if len(rows) <= broadcast_sources:
        table = F.broadcast(docs.sparkSession.createDataFrame(rows, table.schema))
    joined = slim.join(table.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(F.col("_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.select("_id", *(f"_k{i}" for i in range(len(keep))), F.col("size").alias("_size"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), copies.cast("long").alias("_copies"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every column of docs, each row as often as the mix takes it."""
    mixed = mix(docs, keep=docs.columns, **options)
    repeated = mixed.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)))
