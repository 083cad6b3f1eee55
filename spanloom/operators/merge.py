"""Documents of several sources become one table; ids are requested in batches and date windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

DOCUMENT = "document_id string, pmid string, title string, abstract string, full_text string, source string, year string, metadata map<string,string>"


def merge_documents(documents: DataFrame, prefer: list[str]) -> DataFrame:
    """documents(DOCUMENT columns, origin) of all sources -> one row per document_id.

    Sources are asked in the order of prefer (repeats ignored; others are left out): the first non-blank
    title and abstract, the first non-empty full text, year and pmid, the first value of each metadata
    key; source and origin_sources say who contributed.  Winners are picked by narrow min_by aggregates,
    so map-side partial aggregation applies to a hot document, too."""
    order = list(dict.fromkeys(prefer))
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("origin"))
    df = documents.withColumn("_rank", rank).where("_rank > 0")
    first = lambda c, ok: F.min_by(F.when(ok, F.col(c)), F.when(ok, F.col("_rank"))).alias(c)
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    said = lambda c: F.coalesce(strip(c), F.lit("")) != ""
    out = df.groupBy("document_id").agg(
        first("pmid", some("pmid")), first("title", said("title")), first("abstract", said("abstract")), first("full_text", some("full_text")), F.min_by("source", "_rank").alias("source"), first("year", some("year")),
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", "origin"))), lambda x: x["origin"]).alias("origin_sources"), F.array_sort(F.collect_list(F.struct("_rank", F.map_entries("metadata").alias("entries")))).alias("_meta"),
    )
    # the first source's values win: entries of later ones are taken only for keys that are not there yet
    empty = F.create_map().cast("map<string,string>")
    fresh = lambda acc, m: F.map_filter(F.coalesce(F.map_from_entries(m["entries"]), empty), lambda k, _: ~F.map_contains_key(acc, k) & (k != "origin_sources"))
    metadata = F.aggregate("_meta", empty, lambda acc, m: F.map_concat(acc, fresh(acc, m)))
    return out.withColumn("metadata", metadata).withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "abstract")}).drop("_meta")


def blank_body(df_prefix: str = "") -> Column:
    return F.concat(*(F.coalesce(strip(f"{df_prefix}{c}"), F.lit("")) for c in ("title", "abstract", "full_text"))) == ""


def fallback_fill(primary: DataFrame, fallback: DataFrame, requested: DataFrame) -> DataFrame:
    """Primary documents, filled from the fallback where their body is blank, and the fallback's documents
    for requested pmids that the primary lacks.  filled says what happened: kept, filled or appended."""
    columns = ["document_id", "pmid", "title", "abstract", "full_text", "year", "source"]
    extra = fallback.groupBy("pmid").agg(F.min_by(F.struct(*(c for c in columns if c != "pmid")), "document_id").alias("x"))
    joined = primary.select(*columns).join(extra, "pmid", "left")
    fill = blank_body() & F.col("x").isNotNull() & (F.coalesce("pmid", F.lit("")) != "")
    blank = lambda c: F.coalesce(strip(c), F.lit("")) == ""
    kept = joined.withColumns({"_fill": fill} | {f"_{c}": F.when(fill & blank(c), F.coalesce(F.col("x")[c], F.col(c))).otherwise(F.col(c)) for c in ("title", "abstract", "full_text", "year")})
    kept = kept.select("document_id", "pmid", *(F.col(f"_{c}").alias(c) for c in ("title", "abstract", "full_text", "year")), "source", F.when(F.col("_fill"), "filled").otherwise("kept").alias("filled"))
    have = primary.where("coalesce(pmid, '') <> ''").select("pmid").distinct()
    missing = requested.select("pmid").where("pmid IS NOT NULL").distinct().join(have, "pmid", "left_anti").join(extra, "pmid")
    return kept.unionByName(missing.select("x.document_id", "pmid", *(F.col("x")[c].alias(c) for c in ("title", "abstract", "full_text", "year", "source")), F.lit("appended").alias("filled")))


def missing_ids(requested: DataFrame, returned: DataFrame, column: str = "pmid") -> DataFrame:
    return requested.select(column).distinct().join(returned.select(column).distinct(), column, "left_anti")


#: Document fields and what they are without a request.
_TEXT_FIELDS, _NULL_FIELDS = ("title", "abstract"), ("year", "full_text")


def project_fields(documents: DataFrame, fields: list[str], known: list[str], always: tuple[str, ...] = ()) -> DataFrame:
    """Only the requested logical fields: other texts become empty, year and full text null, and metadata
    keeps the requested keys.  An unknown field is an error."""
    if bad := sorted(set(fields) - set(known)):
        raise ValueError(f"unknown fields: {', '.join(bad)}")
    asked = {*fields, *always}
    out = {c: F.lit("") for c in _TEXT_FIELDS if c not in asked} | {c: F.lit(None).cast("string") for c in _NULL_FIELDS if c not in asked}
    out["metadata"] = F.map_filter("metadata", lambda k, _: k.isin(*asked))
    return documents.withColumns(out)


def sources_for_field(advertised: DataFrame, field: str) -> DataFrame:
    """advertised(source, field) -> the sources that know a field, by name."""
    return advertised.where(F.col("field") == field).select("source").distinct().orderBy("source")


def first_occurrences(ids: DataFrame, id_col: str, position_col: str) -> DataFrame:
    """Each id once, at its first position."""
    return ids.where(f"{id_col} IS NOT NULL").groupBy(id_col).agg(F.min(position_col).alias(position_col))


#: Positions of one range of ``numbered``: a range holds at most so many rows where positions differ.
RANGE = 1 << 20


def numbered(df: DataFrame, order: list[str], name: str, ranges: list[Column] | None = None) -> DataFrame:
    """df + a dense number from 0 in the order of the columns ``order``, without sending all rows to one task.

    ranges are columns that depend on a row alone and rise with the order (by default the first order column, a
    whole number, divided by RANGE): rows are numbered within their range, and each range starts after the rows
    of those before it.  Nothing depends on how Spark partitions the rows, which may change between two plans.
    The ranges meet in one task, one row each: positions that are sparse (hashes, times) make almost as many ranges
    as rows, and need ranges of their own."""
    keys = {f"_r{i}": c for i, c in enumerate(ranges or [F.floor(F.col(order[0]) / RANGE)])}
    ranged = df.withColumns(keys)
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranged.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    joined = ranged.withColumn("_i", within).join(starts.drop("_n"), list(keys))
    return joined.withColumn(name, (F.col("_start") + F.col("_i")).cast("long")).drop(*keys, "_i", "_start")


def request_batches(ids: DataFrame, id_col: str, position_col: str, single: int = 100, size: int = 1000) -> DataFrame:
    """batch, ids: one batch for at most ``single`` distinct ids, else batches of ``size`` in order."""
    once = first_occurrences(ids, id_col, position_col)
    n = once.count()
    batch = F.lit(0).cast("long") if n <= single else F.floor(F.col("_n") / size)
    got = numbered(once, [position_col, id_col], "_n").withColumn("batch", batch)
    return got.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", id_col))), lambda x: x[id_col]).alias("ids"))


def distinct_ordered(values: Column | str) -> Column:
    """The values of an array, each once at its first place; nulls and blank strings are dropped."""
    kept = F.filter(values, lambda x: x.isNotNull() & (strip(x) != ""))
    return F.array_distinct(kept)


def partial_date(text: Column | str, upper: bool = False) -> Column:
    """YYYY, YYYY/MM or YYYY/MM/DD (or with dashes) as a date: missing parts are the first ones, or the
    last ones for an upper bound; anything else is null."""
    t = strip(text)
    part = lambda i: F.nullif(F.regexp_extract(t, r"^(\d{4})(?:[/-](\d{1,2}))?(?:[/-](\d{1,2}))?$", i), F.lit("")).cast("int")
    year, month, day = part(1), part(2), part(3)
    first = F.try_to_date(F.concat_ws("-", year.cast("string"), F.lpad(F.coalesce(month, F.lit(12 if upper else 1)).cast("string"), 2, "0"), F.lpad(F.coalesce(day, F.lit(1)).cast("string"), 2, "0")), "yyyy-MM-dd")
    first = F.when(year.isNotNull(), first)
    return F.when(day.isNull(), F.last_day(first)).otherwise(first) if upper else first


def plan_date_windows(rows: DataFrame, date_col: str, cap: int) -> list[tuple[dt.date, dt.date, int]]:
    """Disjoint windows (first day, last day, rows), each of at most cap rows, by halving the range.

    Only daily counts reach the driver: one row per calendar day, whatever the number of rows."""
    days = {r[0]: r[1] for r in rows.groupBy(F.col(date_col).cast("date").alias("d")).count().where("d IS NOT NULL").collect()}
    if not days:
        return []

    def halve(lo: dt.date, hi: dt.date):
        n = sum(c for d, c in days.items() if lo <= d <= hi)
        if n <= cap:
            return [(lo, hi, n)]
        if lo == hi:
            raise ValueError(f"{lo} alone has {n} rows, more than {cap}")
        middle = lo + (hi - lo) // 2
        return halve(lo, middle) + halve(middle + dt.timedelta(days=1), hi)

    return halve(min(days), max(days))


def label_windows(rows: DataFrame, date_col: str, windows: list[tuple[dt.date, dt.date, int]]) -> DataFrame:
    """rows + window_start, window_end: an equi-join on the calendar day, of which a window lists each once."""
    table = rows.sparkSession.createDataFrame([(a, b) for a, b, _ in windows], "window_start date, window_end date")
    days = table.withColumn("_day", F.explode(F.sequence("window_start", "window_end")))
    return rows.withColumn("_day", F.col(date_col).cast("date")).join(days, "_day").drop("_day")
