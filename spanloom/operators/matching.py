"""Matching of predicted and gold spans, always within one document and annotator.

predictions: document_id, source, ordinal, start, end, ...; gold: document_id, ordinal, start, end, ...
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scans import running
from .shared import checkpointed, whole_documents

#: Width of the position buckets of the overlap join.
BUCKET = 512


def scored_predictions(predictions: DataFrame, entity_type: str = "disease") -> DataFrame:
    """Predictions of the type with offsets, renumbered in order per document and annotator."""
    kept = predictions.where("start IS NOT NULL AND end IS NOT NULL").where(F.lower(F.trim("entity_type")) == entity_type)
    # windows over documents, so that what follows finds rows where their document lies: places in the document's order,
    # less the places before the annotator's first row
    by = Window.partitionBy("document_id")
    return kept.withColumn("i", F.row_number().over(by.orderBy("source", "ordinal")) - F.rank().over(by.orderBy("source")) + 1)


def scored_gold(gold: DataFrame, entity_type: str = "disease") -> DataFrame:
    kept = gold.where(F.col("entity_type") == entity_type)
    return kept.withColumn("j", F.row_number().over(Window.partitionBy("document_id").orderBy("ordinal")))


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], columns: list[str], name: str = "_found") -> DataFrame:
    """rows + name: a struct of columns of the table's row with the same keys, null without one; of several rows the
    greatest struct.

    A union and a window instead of a join: tables that lie by document stay there, while a join would deal both
    again by all of the keys.  Keys must not be null."""
    others, types = [c for c in rows.columns if c not in keys], dict(rows.dtypes)
    said = table.select(*keys, F.struct(*columns).alias(name))
    asking = rows.select(*keys, *others, F.lit(None).cast(said.schema[name].dataType).alias(name), F.lit(True).alias("_asks"))
    telling = said.select(*keys, *(F.lit(None).cast(types[c]).alias(c) for c in others), name, F.lit(False).alias("_asks"))
    found = asking.unionByName(telling).withColumn(name, F.max(name).over(Window.partitionBy(*keys)))
    return found.where("_asks").select(*rows.columns, name)


def unmatched(rows: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys no pair has."""
    taken = pairs.select(*keys).withColumn("_taken", F.lit(1))
    return looked_up(rows, taken, keys, ["_taken"]).where("_found IS NULL").drop("_found")


def strict_match(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, source, i, j: the k-th prediction at a place takes the k-th gold span there."""
    place = ["document_id", "start", "end"]
    p = predictions.select(*place, "source", "i", F.row_number().over(Window.partitionBy("document_id", "source", "start", "end").orderBy("i")).alias("k"))
    g = gold.select(*place, "j", F.row_number().over(Window.partitionBy(*place).orderBy("j")).alias("k"))
    return looked_up(p, g, [*place, "k"], ["j"]).where("_found IS NOT NULL").select("document_id", "source", "i", "_found.j")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = BUCKET) -> DataFrame:
    """All pairs of spans that overlap, joined on keys and position buckets.

    left and right have start, end; right's come back as start_r, end_r.  Each pair is kept in the bucket
    where the later of its two starts lies, so none repeats; a long document is spread over many buckets."""
    spread = lambda df: df.where("start < end").withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    l, r = spread(left), spread(right.withColumnRenamed("start", "start_r").withColumnRenamed("end", "end_r").withColumn("start", F.col("start_r")).withColumn("end", F.col("end_r"))).drop("start", "end")
    both = l.join(r, [*keys, "_bucket"]).where((F.col("start") < F.col("end_r")) & (F.col("start_r") < F.col("end")))
    return both.where(F.floor(F.greatest("start", "start_r") / width) == F.col("_bucket")).drop("_bucket")


def overlaps_where_they_lie(left: DataFrame, right: DataFrame, keys: list[str], width: int = BUCKET) -> DataFrame:
    """overlap_join of tables that lie by keys (or some of them): nothing moves, as a bucket's right rows come from a
    window over both tables.  Keys must not be null."""
    spread = lambda df, a, b: df.where(F.col(a) < F.col(b)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor((F.col(b) - 1) / width))))
    l, r = spread(left, "start", "end"), spread(right.withColumnsRenamed({"start": "start_r", "end": "end_r"}), "start_r", "end_r")
    both = _with_all(l, r, [*keys, "_bucket"]).withColumn("_r", F.explode("_all")).where((F.col("start") < F.col("_r.end_r")) & (F.col("_r.start_r") < F.col("end")))
    both = both.where(F.floor(F.greatest("start", "_r.start_r") / width) == F.col("_bucket"))
    return both.select(*left.columns, *(f"_r.{c}" for c in r.columns if c not in (*keys, "_bucket")))


def _with_all(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left + _all: all rows of right with the same keys, by a union and a window."""
    others, types, rest = [c for c in left.columns if c not in keys], dict(left.dtypes), [c for c in right.columns if c not in keys]
    said = right.select(*keys, F.struct(*rest).alias("_one"))
    asking = left.select(*keys, *others, F.lit(None).cast(said.schema["_one"].dataType).alias("_one"))
    telling = said.select(*keys, *(F.lit(None).cast(types[c]).alias(c) for c in others), "_one")
    whole = F.collect_list("_one").over(Window.partitionBy(*keys))
    return asking.unionByName(telling).withColumn("_all", whole).where("_one IS NULL").drop("_one")


_EDGES = "document_id string, source string, block long, kind int, i int, j int, rank long, other long"
#: Kinds of rows of the matching rounds: an open edge, a gold span's holder, a proposal, a refusal.
EDGE, HELD, ASKED, REFUSED = range(4)
#: Positions of a block, in which one round is settled.
BLOCK = 1 << 19
#: Rows of a task of one round.
TASK_ROWS = 500_000


def _settle(first: bool, final: bool):
    return lambda table: _settled(table, first, final)


#: Edges of documents that lie together and are settled at once.
ROUND_ROWS = 100_000
#: Askers below which a round over arrays costs more than asking one by one.
FEW = 64


def _settled_at_once(table: pa.Table) -> pa.Table:
    """The only round of blocks that concern nobody else: all predictions ask at once, over arrays; once few are left,
    as in a long chain of refusals, they ask one by one."""
    names = [x.split()[0] for x in _EDGES.split(", ")]
    codes = [table[c].combine_chunks().dictionary_encode() for c in ("document_id", "source")]
    place = np.asarray(codes[0].indices).astype(np.int64) * len(codes[1].dictionary) + np.asarray(codes[1].indices)
    i, j, rank = (table[c].to_numpy() for c in ("i", "j", "rank"))
    order = np.lexsort((j, rank, i, place))
    place, i, j = place[order], i[order].astype(np.int64), j[order].astype(np.int64)
    at = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (i[1:] != i[:-1])))  # where a prediction's wishes begin
    end, none = np.append(at[1:], len(i)), len(at)
    first = at.copy()
    gold = np.unique(place * (j.max() + 1) + j, return_inverse=True)[1]
    held = np.full(gold.max() + 1, none)  # predictions are numbered in order within their place, so the least is the earliest
    asking = np.arange(none)
    while len(asking) >= FEW:
        wanted = gold[at[asking]]
        asked = np.unique(wanted)
        before = held[asked]
        np.minimum.at(held, wanted, asking)
        refused = np.concatenate([asking[held[wanted] != asking], before[(before != none) & (held[asked] != before)]])
        at[refused] += 1
        asking = refused[at[refused] < end[refused]]
    for p in asking.tolist():
        while at[p] < end[p]:
            taker = held[gold[at[p]]]
            if taker > p:
                held[gold[at[p]]] = p
                if taker == none:
                    break
                p = taker
            at[p] += 1
    kept = held[held < none]
    row, taken = first[kept], at[kept]
    out = table.select(["document_id", "source"]).take(pa.array(order[row]))
    columns = {"block": np.zeros(len(kept)), "kind": np.full(len(kept), HELD), "i": i[row], "j": j[taken], "rank": np.zeros(len(kept)), "other": np.zeros(len(kept))}
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    kinds = {x.split()[0]: types[x.split()[1]] for x in _EDGES.split(", ")}
    return pa.table([out[c].cast(kinds[c]) if c in out.column_names else pa.array(columns[c].astype(np.int64)).cast(kinds[c]) for c in names], names=names)


def _settled_by_document(batches):
    """Pairs of edges that come by document: whole documents are settled at once, several of them where they are short."""
    for table in whole_documents(batches, ROUND_ROWS):
        yield from _settled_at_once(table).select(["document_id", "source", "i", "j"]).to_batches()


def _settled(table: pa.Table, first: bool, final: bool) -> pa.Table:
    """One round of some blocks: their predictions ask (all in the first round, then the refused ones), their gold
    spans answer, until nothing moves inside.  Edges are handed on unless the round is final.

    Edges live in the block of their prediction (other: the block of the gold span), holders in the block of
    their gold span (other: the block of the prediction).  What concerns another block goes out as a message."""
    if first and final and len(table):
        return _settled_at_once(table)
    names = [x.split()[0] for x in _EDGES.split(", ")]
    table = table.sort_by([(c, "ascending") for c in ("document_id", "source", "block", "kind", "i", "rank", "j")])
    columns = [table[c].to_pylist() for c in names]
    wishes, held, waiting, out = {}, {}, [], []
    for document, source, block, kind, i, j, rank, other in zip(*columns, strict=True):
        place = (document, source, block)
        if kind == EDGE:
            wishes.setdefault((place, i), []).append((rank, j, other))
        elif kind == HELD:
            held[place, j] = (i, other)
        elif kind == ASKED:
            waiting.append((place, i, j, other))
        else:  # a gold span of another block took an earlier prediction
            wishes[place, i] = [w for w in wishes[place, i] if w[1] != j]
            waiting.append((place, i, None, block))
    queue = [*wishes] if first else [(place, i) for place, i, j, _ in waiting if j is None]
    proposals = [(place, i, j, home) for place, i, j, home in waiting if j is not None]
    while queue or proposals:
        if proposals:
            place, i, j, home = proposals.pop()
            before = held.get((place, j))
            if before is not None and before[0] <= i:
                loser = (i, home) if before[0] < i else None
            else:
                held[place, j], loser = (i, home), before
            if loser is None:
                continue
            i, home = loser
            if home != place[2]:
                out.append((*place[:2], home, REFUSED, i, j, 0, place[2]))
                continue
            wishes[place, i] = [w for w in wishes[place, i] if w[1] != j]
        else:
            place, i = queue.pop()
        if open_ := wishes.get((place, i)):
            _, j, other = open_[0]
            if other == place[2]:
                proposals.append((place, i, j, other))
            else:
                out.append((*place[:2], other, ASKED, i, j, 0, place[2]))
    if not final:
        out += [(*place, EDGE, i, j, rank, other) for (place, i), ws in wishes.items() for rank, j, other in ws]
    out += [(*place, HELD, i, j, 0, home) for (place, j), (i, home) in held.items()]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    schema = pa.schema([(n, types[x.split()[1]]) for n, x in zip(names, _EDGES.split(", "), strict=True)])
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(names), schema.types, strict=True)], schema=schema)


def _greedy(predictions: DataFrame, gold: DataFrame, best: bool, done: DataFrame | None = None, block: int = BLOCK, task_rows: int = TASK_ROWS, dealt: int = 0) -> DataFrame:
    """Order-dependent one-to-one matching: predictions in order take one free gold span that they overlap, the
    lowest j, or with best the longest overlap (then the lowest j); pairs in done are taken already.

    The pairs are those of deferred acceptance: every prediction asks for its best gold span, a gold span keeps
    the earliest prediction that asked, and refused ones ask for their next.  As all gold spans prefer earlier
    predictions, there is one stable outcome, the serial one, in whatever order they ask.  So blocks of
    positions settle their own requests in one round, however many there are, and only requests across a
    border travel to the next round.  Documents without such requests are final; nothing holds a document.

    With dealt all tables lie by document, in so many partitions; unless a document is longer than a block, which the gold
    spans tell, documents are settled where they lie, and only pairs are dealt again."""
    doc = ["document_id", "source"]
    if done is not None:
        predictions = unmatched(predictions.select(*doc, "i", "start", "end"), done, [*doc, "i"])
    overlaps = overlaps_where_they_lie if dealt else overlap_join
    hits = overlaps(predictions.select(*doc, "i", "start", "end"), gold.select("document_id", "j", "start", "end"), ["document_id"])
    if done is not None and dealt:
        hits = unmatched(hits, done, [*doc, "j"])
    elif done is not None:
        hits = hits.join(done.select(*doc, "j"), [*doc, "j"], "left_anti")
    overlap = F.least("end", "end_r") - F.greatest("start", "start_r")
    rank = (-overlap if best else F.lit(0)).cast("long").alias("rank")
    if dealt and (gold.agg(F.max("end")).first()[0] or 0) <= block:
        edges = hits.select(*doc, F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), rank).sortWithinPartitions("document_id")
        return edges.mapInArrow(_settled_by_document, "document_id string, source string, i int, j int").repartition(dealt, "document_id")
    at = lambda c: F.floor(F.col(c) / block).cast("long")
    rows = hits.select(*doc, at("start").alias("block"), F.lit(EDGE).alias("kind"), F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), rank, at("start_r").alias("other"))
    rows, final = checkpointed(rows), []
    while True:
        tasks = max(8, -(-rows.count() // task_rows))
        task = F.pmod(F.xxhash64(*doc, "block"), F.lit(tasks))
        tables = rows.withColumn("_task", task).repartition(tasks, "_task").groupBy("_task")
        if not final and rows.where("block > 0 OR other > 0").isEmpty():  # all documents are one block: one round settles them
            return tables.applyInArrow(_settle(True, True), _EDGES).select(*doc, "i", "j")
        settled = checkpointed(tables.applyInArrow(_settle(not final, False), _EDGES))
        touched = settled.where(F.col("kind") >= ASKED).select(*doc).distinct()
        pairs = settled.where(F.col("kind") == HELD)
        if touched.isEmpty():
            return reduce(DataFrame.unionByName, [*final, pairs]).select(*doc, "i", "j")
        final.append(pairs.join(touched, doc, "left_anti"))
        rows = settled.join(touched, doc, "left_semi")


def lenient_match(predictions: DataFrame, gold: DataFrame, dealt: int = 0) -> DataFrame:
    """document_id, source, i, j: each prediction takes the first free gold span that it overlaps."""
    return _greedy(predictions, gold, best=False, dealt=dealt)


def boundary_match(predictions: DataFrame, gold: DataFrame, strict: DataFrame, dealt: int = 0) -> DataFrame:
    """document_id, source, i, j of overlaps that are not exact: the strict pairs are taken first, then each
    prediction takes the free gold span of largest overlap."""
    return _greedy(predictions, gold, best=True, done=strict, dealt=dealt)


def nearest_span(probes: DataFrame, candidates: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """probes + nearest_ordinal, nearest_distance: the candidate span of the same keys at the least
    distance (0 if they touch or overlap), the first in order of ties; null without candidates.

    Candidates that start before the probe's start and those that start after it are looked up by one
    two-level scan in either direction over the union of both, so nothing is paired with everything and a document
    of many spans is many tasks."""
    c = candidates.select(*keys, F.col("start").alias("s"), F.col("end").alias("e"), F.col(ordinal).alias("o"))
    p = probes.select(*keys, "start", "end").distinct()
    none = lambda name: F.lit(None).cast("int").alias(name)
    events = c.select(*keys, F.col("s").alias("at"), F.lit(0).alias("kind"), "s", "e", none("start"), none("end"))
    events = events.unionByName(p.select(*keys, F.col("start").alias("at"), F.lit(1).alias("kind"), none("s"), none("e"), "start", "end"))
    marked = running(events, keys, ["at", "kind"], {"reach": ("max", "e", True), "next": ("min", "s", True, True)}, back=[-F.col("at"), F.col("kind")]).where("kind = 1")
    back, ahead = (F.when(x.isNotNull(), F.greatest(x, F.lit(0))) for x in (F.col("start") - F.col("reach"), F.col("next") - F.col("end")))
    known = marked.select(*keys, "start", "end", F.least(back, ahead).alias("nearest_distance"))  # least skips nulls
    # spans within that distance of the probe, end to end, are the nearest ones: an overlap join finds them
    wide = known.withColumns({"ps": F.col("start"), "pe": F.col("end")}).withColumns({"start": F.greatest(F.col("ps") - F.col("nearest_distance") - 1, F.lit(0)), "end": F.col("pe") + F.col("nearest_distance") + 1}).where("nearest_distance IS NOT NULL")
    hits = overlap_join(wide, c.withColumnsRenamed({"s": "start", "e": "end"}), keys)
    distance = F.greatest(F.col("ps") - F.col("end_r"), F.col("start_r") - F.col("pe"), F.lit(0))
    best = hits.where(distance == F.col("nearest_distance")).groupBy(*keys, F.col("ps").alias("start"), F.col("pe").alias("end")).agg(F.min("o").alias("nearest_ordinal"), F.first("nearest_distance").alias("nearest_distance"))
    return probes.join(best, [*keys, "start", "end"], "left")


def nearest_where_they_lie(probes: DataFrame, candidates: DataFrame, keys: list[str], ordinal: str, row: list[str], width: int = BUCKET) -> DataFrame:
    """document_id, the columns of row (which with keys name a probe), nearest_ordinal and nearest_distance as nearest_span
    tells them, of probes and candidates that lie by document: nothing moves.

    The last end before a probe and the first start after it come from windows, with the first candidate that has it.
    Only a probe that something touches or overlaps looks at the candidates of its position buckets."""
    names = list(dict.fromkeys([*keys, *row]))
    c = candidates.select(*keys, F.col("start").alias("s"), F.col("end").alias("e"), F.col(ordinal).cast("int").alias("o"))
    others, types = [x for x in names if x not in keys], dict(probes.dtypes)
    none = lambda name, kind="int": F.lit(None).cast(kind).alias(name)
    events = c.select(*keys, F.col("s").alias("at"), F.lit(0).alias("kind"), F.struct("e", (-F.col("o")).alias("o")).alias("before"), F.struct("s", "o").alias("after"), *(none(x, types[x]) for x in [*others, "start", "end"]))
    events = events.unionByName(probes.select(*keys, F.col("start").alias("at"), F.lit(1).alias("kind"), *(none(x, events.schema[x].dataType) for x in ("before", "after")), *others, "start", "end"))
    by = Window.partitionBy(*keys)
    whole = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    marked = events.withColumn("_b", F.max("before").over(whole(by.orderBy("at", "kind")))).withColumn("_a", F.min("after").over(whole(by.orderBy(F.desc("at"), "kind")))).where("kind = 1")
    back, ahead = (F.when(x.isNotNull(), F.greatest(x, F.lit(0))) for x in (F.col("start") - F.col("_b.e"), F.col("_a.s") - F.col("end")))
    known = marked.select(*names, "start", "end", back.alias("_back"), ahead.alias("_ahead"), (-F.col("_b.o")).alias("_ob"), F.col("_a.o").alias("_oa"), F.least(back, ahead).alias("nearest_distance"))
    apart = F.least(F.when(F.col("_back") == F.col("nearest_distance"), F.col("_ob")), F.when(F.col("_ahead") == F.col("nearest_distance"), F.col("_oa")))
    known = known.withColumn("_o", F.when(F.col("nearest_distance") > 0, apart)).drop("_back", "_ahead", "_ob", "_oa")
    # a probe's buckets are those that it touches; a candidate's those that it fills
    of = lambda a, b: F.explode(F.sequence(F.floor(a / width), F.floor(b / width)))
    a, b = F.greatest(F.col("start") - 1, F.lit(0)), F.when(F.col("nearest_distance") == 0, F.col("end") + 1).otherwise(F.greatest(F.col("start") - 1, F.lit(0)))
    near = _with_all(known.withColumn("_bucket", of(a, F.greatest(a, F.coalesce(b, a)))), c.where("s <= e").withColumn("_bucket", of(F.col("s"), F.col("e"))), [*keys, "_bucket"])
    touching = F.filter("_all", lambda x: (x["s"] <= F.col("end")) & (x["e"] >= F.col("start")))
    found = near.select(*names, "nearest_distance", F.when(F.col("nearest_distance") == 0, F.array_min(F.transform(touching, lambda x: x["o"]))).otherwise(F.col("_o")).alias("o"))
    return found.groupBy(*names).agg(F.min("o").alias("nearest_ordinal"), F.first("nearest_distance").alias("nearest_distance"))
