"""Queries of the scoring workload: matching, metrics, errors and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identifiers import gold_value_aliases, prediction_aliases
from ..operators import matching as M
from ..operators import metrics as S
from . import fixtures as X


#: What matching reads of predictions.
_PLACES = ["document_id", "source", "ordinal", "start", "end", "entity_type"]


_NAMED = [*_PLACES, "canonical_id"]


def _inputs(spark, d, text: bool = False, columns=None, dealt: int = 0):
    gold = X.gold_with_text(spark, d, dealt=dealt) if text else X.gold(spark, d, dealt=dealt)
    return M.scored_predictions(X.annotations(spark, d, dealt=dealt, columns=columns)), M.scored_gold(gold)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def p15_identifier_aliases(spark, d):
    return X.annotations(spark, d).select("document_id", "annotation_id", "ordinal", F.array_join(F.array_sort(prediction_aliases("canonical_id")), "|").alias("aliases"))


def p15_gold_aliases(spark, d):
    return X.gold(spark, d).select("document_id", "ordinal", F.array_join(F.array_sort(F.array_distinct(F.flatten(gold_value_aliases("normalized_ids")))), "|").alias("aliases"))


def j01_strict_match(spark, d):
    return M.strict_match(*_inputs(spark, d, columns=_PLACES))


def j02_lenient_match(spark, d):
    return M.lenient_match(*_inputs(spark, d, columns=_PLACES))


def j03_boundary_match(spark, d):
    n = X.partitions(spark, d)
    p, g = _inputs(spark, d, columns=_PLACES, dealt=n)
    return M.boundary_match(p, g, M.strict_match(p, g), n)


def j04_nearest_span(spark, d):
    p, g = _inputs(spark, d, columns=_PLACES)
    free = M.unmatched(p, M.strict_match(p, g), ["document_id", "source", "i"])
    return M.nearest_span(free, g, ["document_id"], "j").select("document_id", "source", "i", "nearest_ordinal", "nearest_distance")


def j05_overlap_join(spark, d):
    p, g = _inputs(spark, d, columns=_PLACES)
    hits = M.overlap_join(p.select("document_id", "source", "i", "start", "end"), g.select("document_id", "j", "start", "end"), ["document_id"])
    return hits.select("document_id", "source", "i", "j")


def j11_normalization_outcome(spark, d):
    p, g = _inputs(spark, d)
    return S.normalization_outcomes(p, g, M.strict_match(p, g))


def a07_match_metrics_strict(spark, d):
    p, g = _inputs(spark, d, columns=_PLACES)
    return _rounded(S.match_metrics(p, g, M.strict_match(p, g)), "precision", "recall", "f1")


def a07_match_metrics_lenient(spark, d):
    p, g = _inputs(spark, d, columns=_PLACES)
    return _rounded(S.match_metrics(p, g, M.lenient_match(p, g)), "precision", "recall", "f1")


def a08_normalization_metrics(spark, d):
    p, g = _inputs(spark, d, columns=_NAMED, dealt=X.partitions(spark, d))
    df = S.normalization_metrics(S.normalization_outcomes(p, g, M.strict_match(p, g)))
    return _rounded(df, "accuracy", "precision", "recall", "gold_id_coverage", "prediction_id_coverage", "all_ids_rate")


def a08_normalization_metrics_lenient(spark, d):
    n = X.partitions(spark, d)
    p, g = _inputs(spark, d, columns=_NAMED, dealt=n)
    df = S.normalization_metrics(S.normalization_outcomes(p, g, M.lenient_match(p, g, n)))
    return _rounded(df, "accuracy", "precision", "recall", "gold_id_coverage", "prediction_id_coverage", "all_ids_rate")


def a09_gold_coverage(spark, d):
    return S.gold_coverage(X.annotations(spark, d, columns=["document_id", "source", "start", "end", "canonical_id"]), M.scored_gold(X.gold(spark, d)), X.ANNOTATORS).select("document_id", "start", "end", "source", "copies", "state")


def _vectors(spark, d):
    return S.state_vectors(a09_gold_coverage(spark, d), X.ANNOTATORS)


def a10_coverage_groups(spark, d):
    return S.coverage_groups(_vectors(spark, d))


def a11_annotator_combinations(spark, d):
    return _rounded(S.annotator_combinations(_vectors(spark, d), X.ANNOTATORS), "lenient_rate", "strict_rate", "norm_rate")


#: What tables of errors show of predictions.
_SHOWN = [*_PLACES, "span_text", "canonical_id"]


def _matched(spark, d):
    """Predictions and gold spans with their texts, exact pairs and boundary pairs, all by document; what is matched reads places only."""
    n = X.partitions(spark, d)
    p, g = _inputs(spark, d, columns=_PLACES, dealt=n)
    strict = M.strict_match(p, g)
    return *_inputs(spark, d, text=True, columns=_SHOWN, dealt=n), strict, M.boundary_match(p, g, strict, n)


def a12_boundary_errors(spark, d):
    p, g, _, boundary = _matched(spark, d)
    return S.boundary_errors(p, g, boundary, True).select("document_id", "source", "i", "j", "prediction_text", "prediction_start", "prediction_end", "prediction_canonical_id", "gold_text", "gold_start", "gold_end", "gold_normalized_ids", "overlap_length")


def a12_false_positives(spark, d):
    p, g, strict, boundary = _matched(spark, d)
    df = S.false_positives(p, g, strict.unionByName(boundary), True)
    return df.select("document_id", "source", "i", "span_text", "start", "end", "nearest_ordinal", "nearest_distance", "nearest_text", "nearest_start", "nearest_end")


def a12_false_negatives(spark, d):
    p, g, strict, boundary = _matched(spark, d)
    df = S.false_negatives(p, g, strict.unionByName(boundary), X.ANNOTATORS, True)
    return df.select("document_id", "source", "j", "span_text", "start", "end", "nearest_ordinal", "nearest_distance", "nearest_text", "nearest_start", "nearest_end")


def k05_metrics_table(spark, d):
    """One flat row per annotator: match and identifier figures of both modes."""
    n = X.partitions(spark, d)
    p, g = _inputs(spark, d, columns=_NAMED, dealt=n)
    parts = []
    for mode, pairs in (("strict", M.strict_match(p, g)), ("lenient", M.lenient_match(p, g, n))):
        counts, ids = S.match_metrics(p, g, pairs), S.normalization_metrics(S.normalization_outcomes(p, g, pairs))
        df = counts.join(ids.withColumnsRenamed({"precision": "id_precision", "recall": "id_recall"}), "source", "left")
        df = _rounded(df, *(c for c, t in df.dtypes if t == "double"))
        parts.append(df.select("source", *(F.col(c).alias(f"{mode}_{c}") for c in df.columns if c not in ("source", "prediction_count", "gold_count")), *(("prediction_count", "gold_count") if mode == "strict" else ())))
    return parts[0].join(parts[1], "source")


QUERIES = {f.__name__: f for f in (p15_identifier_aliases, p15_gold_aliases, j01_strict_match, j02_lenient_match, j03_boundary_match, j04_nearest_span, j05_overlap_join, j11_normalization_outcome, a07_match_metrics_strict, a07_match_metrics_lenient, a08_normalization_metrics, a08_normalization_metrics_lenient, a09_gold_coverage, a10_coverage_groups, a11_annotator_combinations, a12_boundary_errors, a12_false_positives, a12_false_negatives, k05_metrics_table)}

# identifiers of the fixtures: a value, or a bracketed list; prefixes in upper case with their aliases
_ALIAS = """list_distinct(flatten(list_transform({0}, lambda x: list_distinct([replace(replace(replace(x, 'MSH:', 'MESH:'), 'OMIM:', 'MIM:'), 'MIM:', 'OMIM:'), string_split(x, ':')[2]]))))"""
_VALUES = "CASE WHEN canonical_id IS NULL THEN [] WHEN canonical_id LIKE '[%]' THEN list_transform(string_split(substr(canonical_id, 2, length(canonical_id) - 2), ','), lambda x: upper(trim(x, ' '''))) ELSE [upper(canonical_id)] END"
_P = "WITH " + X.SQL_PREDICTIONS + f""",
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, source ORDER BY ordinal) AS i, {_ALIAS.format(_VALUES)} AS pa FROM ann WHERE entity_type = 'disease'),
g AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) AS j, {_ALIAS.format("ids")} AS ga FROM goldt WHERE entity_type = 'disease'),
pk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, start_, end_ ORDER BY i) AS k FROM p),
gk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, start_, end_ ORDER BY j) AS k FROM g),
strict AS (SELECT pk.document_id, pk.doc_id, pk.source, pk.i, gk.j, pk.pa, gk.ga, gk.ids FROM pk JOIN gk ON pk.doc_id = gk.doc_id AND pk.start_ = gk.start_ AND pk.end_ = gk.end_ AND pk.k = gk.k),
outcome AS (SELECT document_id, source, i, j, CASE WHEN len(ga) = 0 THEN 'missing_gold_id' WHEN len(pa) = 0 THEN 'missing_prediction_id' WHEN list_has_any(pa, ga) THEN 'correct' ELSE 'incorrect' END AS outcome,
  len(list_filter(ids, lambda x: NOT list_has_any(pa, [x, string_split(x, ':')[2]]))) = 0 AS all_recovered FROM strict)"""
# A document falls into islands where no later prediction can reach a gold span that an earlier one could; one fold each.
_FOLD = """, {0}ask AS (SELECT doc_id, source, i, list(j ORDER BY {1}) AS c, min(j) AS low, max(j) AS high FROM {0}hit GROUP BY ALL),
{0}far AS (SELECT *, min(low) OVER (PARTITION BY doc_id, source ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later, max(high) OVER (PARTITION BY doc_id, source ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {0}ask),
{0}island AS (SELECT doc_id, source, i, c, sum(CASE WHEN before IS NULL OR later > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, source ORDER BY i) AS island FROM {0}far),
{0}fold AS (SELECT doc_id, source, list(i ORDER BY i) AS ps, list_reduce(list_prepend(CAST([] AS BIGINT[]), list(c ORDER BY i)), lambda a, c: list_append(a, coalesce(list_filter(c, lambda j: NOT list_contains(a, j))[1], 0))) AS js FROM {0}island GROUP BY doc_id, source, island),
{0} AS MATERIALIZED (SELECT doc_id, 'DOC:' || doc_id AS document_id, source, i, j FROM (SELECT doc_id, source, unnest(ps) AS i, unnest(js) AS j FROM {0}fold) WHERE j > 0)"""
_OVERLAPS = "SELECT p.doc_id, p.source, p.i, g.j, least(p.end_, g.end_) - greatest(p.start_, g.start_) AS len FROM p JOIN g ON p.doc_id = g.doc_id AND greatest(p.start_, g.start_) < least(p.end_, g.end_)"
_LENIENT = _P + f", lenienthit AS ({_OVERLAPS})" + _FOLD.format("lenient", "j")
_BOUNDARY = _P + f", boundaryhit AS (SELECT o.* FROM ({_OVERLAPS}) o ANTI JOIN strict s ON o.doc_id = s.doc_id AND o.source = s.source AND o.i = s.i ANTI JOIN strict t ON o.doc_id = t.doc_id AND o.source = t.source AND o.j = t.j)" + _FOLD.format("boundary", "-len, j")
_TAKEN = _BOUNDARY + ", taken AS (SELECT doc_id, source, i, j FROM strict UNION ALL SELECT doc_id, source, i, j FROM boundary)"
_LENIENT_OUTCOME = _LENIENT + """, lout AS (SELECT l.source, CASE WHEN len(ga) = 0 THEN 'missing_gold_id' WHEN len(pa) = 0 THEN 'missing_prediction_id' WHEN list_has_any(pa, ga) THEN 'correct' ELSE 'incorrect' END AS outcome,
  len(list_filter(ids, lambda x: NOT list_has_any(pa, [x, string_split(x, ':')[2]]))) = 0 AS all_recovered FROM lenient l JOIN p ON p.doc_id = l.doc_id AND p.source = l.source AND p.i = l.i JOIN g ON g.doc_id = l.doc_id AND g.j = l.j)"""
_RATE = "round(CASE WHEN ({1}) <> 0 THEN ({0}) / CAST({1} AS DOUBLE) ELSE 0 END, 6)"
_COVER = _P + f""",
lastg AS (SELECT doc_id, document_id, start_, end_, arg_max(ids, ordinal) AS ids, count(*) AS copies FROM g GROUP BY ALL),
lg AS (SELECT *, {_ALIAS.format("ids")} AS ga FROM lastg),
pp AS (SELECT *, {_ALIAS.format(_VALUES)} AS pa FROM ann),
hit AS (SELECT lg.doc_id, lg.start_, lg.end_, pp.source, max(CASE WHEN lg.start_ = pp.start_ AND lg.end_ = pp.end_ THEN CASE WHEN len(ga) > 0 AND len(pa) > 0 AND list_has_all(pa, ga) THEN 3 ELSE 2 END ELSE 1 END) AS state
  FROM lg JOIN pp ON lg.doc_id = pp.doc_id AND greatest(lg.start_, pp.start_) < least(lg.end_, pp.end_) GROUP BY ALL),
cov AS (SELECT lg.doc_id, lg.document_id, lg.start_, lg.end_, s.source, lg.copies, coalesce(state, 0) AS state FROM lg CROSS JOIN (SELECT unnest(['a1', 'a2', 'a3', 'a4', 'a5']) AS source) s LEFT JOIN hit ON hit.doc_id = lg.doc_id AND hit.start_ = lg.start_ AND hit.end_ = lg.end_ AND hit.source = s.source),
vec AS (SELECT doc_id, start_, end_, any_value(copies) AS copies, list(state ORDER BY source) AS st FROM cov GROUP BY ALL)"""

def _metrics_sql(pairs: str) -> str:
    """Counts and ratios of an annotator's pairs."""
    return f""", c AS (SELECT source, count(*) AS prediction_count FROM p GROUP BY ALL), t AS (SELECT source, count(*) AS n FROM {pairs} GROUP BY ALL),
x AS (SELECT c.source, prediction_count, coalesce(n, 0) AS tp, (SELECT count(*) FROM g) AS gold_count FROM c LEFT JOIN t USING (source)),
m AS (SELECT source, prediction_count, gold_count, tp, prediction_count - tp AS fp, gold_count - tp AS fn, {_RATE.format("tp", "prediction_count")} AS precision, {_RATE.format("tp", "gold_count")} AS recall,
  round(CASE WHEN tp > 0 THEN 2.0 * tp / (prediction_count + gold_count) ELSE 0 END, 6) AS f1 FROM x)"""


def _outcomes_sql(outcome: str) -> str:
    """Outcome counts and ratios of an annotator's identifiers."""
    return f""", oc AS (SELECT source, count(*) AS span_matches, count(*) FILTER (WHERE outcome = 'correct') AS correct, count(*) FILTER (WHERE outcome = 'incorrect') AS incorrect,
  count(*) FILTER (WHERE outcome = 'missing_prediction_id') AS missing_prediction_id, count(*) FILTER (WHERE outcome = 'missing_gold_id') AS missing_gold_id,
  count(*) FILTER (WHERE outcome = 'correct' AND all_recovered) AS all_gold_ids_recovered, count(*) FILTER (WHERE outcome = 'correct' AND NOT all_recovered) AS partially_correct FROM {outcome} GROUP BY ALL),
ot AS (SELECT *, correct + incorrect + missing_prediction_id AS comparable_gold_spans, correct + incorrect + missing_gold_id AS prediction_id_spans FROM oc),
om AS (SELECT *, {_RATE.format("correct", "(correct + incorrect)")} AS accuracy, {_RATE.format("correct", "prediction_id_spans")} AS precision, {_RATE.format("correct", "comparable_gold_spans")} AS recall,
  {_RATE.format("comparable_gold_spans", "span_matches")} AS gold_id_coverage, {_RATE.format("prediction_id_spans", "span_matches")} AS prediction_id_coverage, {_RATE.format("all_gold_ids_recovered", "comparable_gold_spans")} AS all_ids_rate FROM ot)"""


_COUNTS = ("tp", "fp", "fn", "precision", "recall", "f1")
_OUTCOMES = ("span_matches", "correct", "incorrect", "missing_prediction_id", "missing_gold_id", "all_gold_ids_recovered", "partially_correct", "comparable_gold_spans", "prediction_id_spans", "accuracy", "id_precision", "id_recall", "gold_id_coverage", "prediction_id_coverage", "all_ids_rate")


def _flat_sql(mode: str) -> str:
    columns = ", ".join([f"m.{c} AS {mode}_{c}" for c in _COUNTS] + [f"om.{c.removeprefix('id_') if c in ('id_precision', 'id_recall') else c} AS {mode}_{c}" for c in _OUTCOMES])
    return f"SELECT m.source, prediction_count, gold_count, {columns} FROM m LEFT JOIN om ON om.source = m.source"


def _nearest_sql(free: str, near: str, row: str, o: str, keys: str) -> str:
    """The rows of free with the nearest span of near (same keys), its text and place.

    The least distance comes from the last end before and the first start after, by two ordered passes; spans at
    that distance touch the widened probe, and are looked up in position buckets."""
    same = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))
    return f""", ev AS (SELECT {keys}, start_ AS place, 0 AS kind, start_ AS s, end_ AS e, CAST(NULL AS BIGINT) AS fs, CAST(NULL AS BIGINT) AS fe FROM {near} UNION ALL SELECT DISTINCT {keys}, start_, 1, NULL, NULL, start_, end_ FROM {free}),
mk AS (SELECT *, max(e) OVER (PARTITION BY {keys} ORDER BY place, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reach, min(s) OVER (PARTITION BY {keys} ORDER BY place DESC, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ahead FROM ev),
ds AS (SELECT {keys}, fs, fe, least(CASE WHEN reach IS NOT NULL THEN greatest(fs - reach, 0) END, CASE WHEN ahead IS NOT NULL THEN greatest(ahead - fe, 0) END) AS dist FROM mk WHERE kind = 1),
wide AS (SELECT *, unnest(range(greatest(fs - dist - 1, 0) // 64, (fe + dist + 1) // 64 + 1)) AS bucket FROM ds WHERE dist IS NOT NULL),
spot AS (SELECT {keys}, {o} AS o, start_, end_, unnest(range(start_ // 64, end_ // 64 + 1)) AS bucket FROM {near}),
b AS (SELECT {", ".join("wide." + k for k in keys.split(", "))}, fs, fe, CAST(min(o) AS INTEGER) AS o, CAST(min(dist) AS INTEGER) AS dist FROM wide JOIN spot n ON {same("wide", "n")} AND wide.bucket = n.bucket AND greatest(fs - n.end_, n.start_ - fe, 0) = dist GROUP BY ALL)
SELECT f.document_id, f.source, f.{row}, f.span_text, f.start_ AS start, f.end_ AS "end", b.o AS nearest_ordinal, b.dist AS nearest_distance, n.span_text AS nearest_text, n.start_ AS nearest_start, n.end_ AS nearest_end
FROM {free} f LEFT JOIN b ON {same("f", "b")} AND f.start_ = b.fs AND f.end_ = b.fe LEFT JOIN {near} n ON {same("n", "f")} AND n.{o} = b.o"""


ORACLE_SQL = {
    "j02_lenient_match": _LENIENT + " SELECT document_id, source, i, CAST(j AS INTEGER) AS j FROM lenient",
    "j03_boundary_match": _BOUNDARY + " SELECT document_id, source, i, CAST(j AS INTEGER) AS j FROM boundary",
    "a07_match_metrics_lenient": _LENIENT + _metrics_sql("lenient") + " SELECT * FROM m",
    "a08_normalization_metrics_lenient": _LENIENT_OUTCOME + _outcomes_sql("lout") + " SELECT * FROM om",
    "k05_metrics_table": "SELECT s.*, l.* EXCLUDE (source, prediction_count, gold_count) FROM (" + _P + _metrics_sql("strict") + _outcomes_sql("outcome") + " " + _flat_sql("strict") + ") s JOIN (" + _LENIENT_OUTCOME + _metrics_sql("lenient") + _outcomes_sql("lout") + " " + _flat_sql("lenient") + ") l ON l.source = s.source",
    "a12_boundary_errors": _BOUNDARY + """ SELECT b.document_id, b.source, b.i, CAST(b.j AS INTEGER) AS j, p.span_text AS prediction_text, p.start_ AS prediction_start, p.end_ AS prediction_end, p.canonical_id AS prediction_canonical_id,
  g.span_text AS gold_text, g.start_ AS gold_start, g.end_ AS gold_end, array_to_string(g.ids, ';') AS gold_normalized_ids, least(p.end_, g.end_) - greatest(p.start_, g.start_) AS overlap_length
FROM boundary b JOIN p ON p.doc_id = b.doc_id AND p.source = b.source AND p.i = b.i JOIN g ON g.doc_id = b.doc_id AND g.j = b.j""",
    "a12_false_positives": _TAKEN + ", free AS MATERIALIZED (SELECT p.* FROM p ANTI JOIN taken USING (doc_id, source, i))" + _nearest_sql("free", "g", "i", "j", "doc_id"),
    "a12_false_negatives": _TAKEN + ", each AS (SELECT g.*, s.source FROM g CROSS JOIN (SELECT unnest(['a1', 'a2', 'a3', 'a4', 'a5']) AS source) s), free AS MATERIALIZED (SELECT each.* FROM each ANTI JOIN taken USING (doc_id, source, j))" + _nearest_sql("free", "p", "j", "i", "doc_id, source"),
    "p15_identifier_aliases": _P + f" SELECT document_id, annotation_id, ordinal, array_to_string(list_sort({_ALIAS.format(_VALUES)}), '|') AS aliases FROM ann",
    "p15_gold_aliases": "WITH " + X.SQL_GOLD + f" SELECT document_id, ordinal, array_to_string(list_sort({_ALIAS.format('ids')}), '|') AS aliases FROM gold",
    "j01_strict_match": _P + " SELECT document_id, source, i, j FROM strict",
    "j04_nearest_span": _P + """, free AS (SELECT p.* FROM p ANTI JOIN strict USING (doc_id, source, i)),
d AS (SELECT f.document_id, f.source, f.i, g.j, CASE WHEN g.j IS NOT NULL THEN greatest(f.start_ - g.end_, g.start_ - f.end_, 0) END AS dist FROM free f LEFT JOIN g ON f.doc_id = g.doc_id)
SELECT document_id, source, i, CAST(arg_min(j, struct_pack(a := dist, b := j)) AS INTEGER) AS nearest_ordinal, CAST(min(dist) AS INTEGER) AS nearest_distance FROM d GROUP BY ALL""",
    "j05_overlap_join": _P + " SELECT p.document_id, source, i, j FROM p JOIN g ON p.doc_id = g.doc_id AND greatest(p.start_, g.start_) < least(p.end_, g.end_)",
    "j11_normalization_outcome": _P + " SELECT * FROM outcome",
    "a07_match_metrics_strict": _P + _metrics_sql("strict") + " SELECT * FROM m",
    "a08_normalization_metrics": _P + _outcomes_sql("outcome") + " SELECT * FROM om",
    "a09_gold_coverage": _COVER + ' SELECT document_id, start_ AS start, end_ AS "end", source, copies, state FROM cov',
    "a10_coverage_groups": _COVER + """, f AS (SELECT *, len(list_filter(st, lambda s: s >= 1)) AS n, list_min(st) AS low FROM vec)
SELECT CASE WHEN n = 0 THEN 'missed_by_all' WHEN n = 1 THEN 'found_by_1' WHEN n = 2 THEN 'found_by_2' WHEN low < 2 THEN 'found_not_all_strict' WHEN low < 3 THEN 'strict_not_all_ids' ELSE 'strict_all_ids' END AS coverage_group, CAST(sum(copies) AS BIGINT) AS gold_count FROM f GROUP BY ALL""",
    "a11_annotator_combinations": _COVER + """, b AS (SELECT unnest(range(1, 32)) AS mask),
s AS (SELECT mask, list_filter([1, 2, 3, 4, 5], lambda k: (mask >> (k - 1)) & 1 = 1) AS ks FROM b),
x AS (SELECT 'a' || array_to_string(ks, '+a') AS label, len(ks) AS size, copies, list_max(list_transform(ks, lambda k: st[k])) AS best FROM s CROSS JOIN vec),
y AS (SELECT label, CAST(size AS INTEGER) AS size, CAST(sum(copies) AS BIGINT) AS total, CAST(coalesce(sum(copies) FILTER (WHERE best >= 1), 0) AS BIGINT) AS lenient_count, CAST(coalesce(sum(copies) FILTER (WHERE best >= 2), 0) AS BIGINT) AS strict_count, CAST(coalesce(sum(copies) FILTER (WHERE best >= 3), 0) AS BIGINT) AS norm_count FROM x GROUP BY ALL)
SELECT label, size, lenient_count, strict_count, norm_count, round(lenient_count / CAST(total AS DOUBLE), 6) AS lenient_rate, round(strict_count / CAST(total AS DOUBLE), 6) AS strict_rate, round(norm_count / CAST(total AS DOUBLE), 6) AS norm_rate FROM y""",
}
