"""Corpus statistics of annotated corpora: rows with nested entities and relations, and tagged sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scans
from .shared import checkpointed

ENTITY = "struct<id:string,type:string,text:array<string>,offsets:array<array<int>>,normalized:array<struct<db_name:string,db_id:string>>>"
CORPUS_ROW = f"document_id string, passages array<struct<type:string,text:array<string>,offsets:array<array<int>>>>, entities array<{ENTITY}>, relations array<struct<type:string,arg1_id:string,arg2_id:string>>"
IOB_ROW = "id string, tokens array<string>, ner_tags array<int>"


def describe(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """count, mean, min, median (interpolated) and max of a numeric column."""
    x = F.col(column)
    return df.groupBy(*(by or [])).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.percentile(x, F.lit(0.5)).alias("median"), F.max(x).alias("max"))


def entities_table(rows: DataFrame) -> DataFrame:
    """One row per entity: its text parts joined by a blank, its length and number of ids."""
    e = rows.select("document_id", F.posexplode("entities").alias("ordinal", "e"))
    text = F.array_join(F.filter("e.text", lambda t: t.isNotNull()), " ")
    return e.select("document_id", "ordinal", "e.id", "e.type", text.alias("text"), F.length(text).alias("span_length"), F.coalesce(F.size("e.normalized"), F.lit(0)).alias("norm_count"), "e.normalized")


def corpus_counts(rows: DataFrame) -> DataFrame:
    """Documents, mentions and documents with mentions; nothing is shuffled but one row per task."""
    n = F.coalesce(F.size(F.col("entities")), F.lit(0))
    n = F.when(n > 0, n).otherwise(0)
    return rows.agg(F.count("*").alias("documents"), F.sum(n).alias("mentions"), F.count_if(n > 0).alias("documents_with_mentions"))


def mentions_by_type(entities: DataFrame) -> DataFrame:
    return entities.groupBy("type").agg(F.count("*").alias("mentions"))


def entities_per_document(rows: DataFrame) -> DataFrame:
    """Only documents that have an entity count; rows are whole documents, so sizes need no shuffle."""
    return describe(rows.select(F.size("entities").alias("n_entities")).where("n_entities > 0"), "n_entities")


def span_length_stats(entities: DataFrame) -> DataFrame:
    return describe(entities, "span_length")


def normalization_coverage(entities: DataFrame) -> DataFrame:
    some = F.count_if(F.col("norm_count") > 0)
    return entities.agg(some.alias("normalized"), F.count("*").alias("total"), F.bround(100 * some / F.count("*"), 1).alias("pct"))


def ids_per_database(entities: DataFrame) -> DataFrame:
    return entities.select(F.explode("normalized").alias("n")).groupBy(F.col("n.db_name").alias("db_name")).agg(F.count("*").alias("ids"))


def relations_table(rows: DataFrame) -> DataFrame:
    """One row per relation with its chemical and its disease.  Entities and relations stand in the same
    row, so arguments are looked up in a map: no join.  Of repeated entity ids the last one counts."""
    usable = rows.where("entities IS NOT NULL AND relations IS NOT NULL")
    name = lambda e: F.array_join(F.filter(e["text"], lambda t: t.isNotNull()), " ")
    value = lambda e: F.named_struct(F.lit("type"), e["type"], F.lit("text"), name(e), F.lit("db_id"), F.coalesce(F.get(e["normalized"], F.lit(0))["db_id"], F.lit("")))
    usable = rows.where("entities IS NOT NULL AND relations IS NOT NULL")
    ids = F.transform("entities", lambda e: e["id"])
    usable = usable.select("document_id", "relations", ids.alias("ids"), F.array_distinct(ids).alias("once"), F.transform("entities", value).alias("values"))
    # ids once each; only where some repeat is the last of their entities looked for
    last = F.transform("once", lambda i: F.get("values", F.size("ids") - F.array_position(F.reverse("ids"), i).cast("int")))
    usable = usable.select("document_id", "relations", F.when(F.size("once") == F.size("ids"), F.map_from_arrays("ids", "values")).otherwise(F.map_from_arrays("once", last)).alias("m"))
    found = F.transform("relations", lambda r: F.named_struct(F.lit("type"), r["type"], F.lit("a"), F.element_at("m", r["arg1_id"]), F.lit("b"), F.element_at("m", r["arg2_id"])))
    r = usable.select("document_id", F.posexplode(found).alias("ordinal", "r")).select("document_id", "ordinal", F.col("r.type").alias("type"), F.col("r.a").alias("a"), F.col("r.b").alias("b"))
    pick = lambda kind: F.when(F.col("a.type") == kind, F.col("a")).when(F.col("b.type") == kind, F.col("b"))
    chemical, disease = pick("Chemical"), pick("Disease")
    empty = lambda x: F.coalesce(x, F.lit(""))
    return r.select("document_id", "ordinal", "type", empty(chemical["text"]).alias("chemical"), empty(chemical["db_id"]).alias("chemical_id"), empty(disease["text"]).alias("disease"), empty(disease["db_id"]).alias("disease_id"))


def relation_stats(rows: DataFrame) -> DataFrame:
    """describe of relations per document that has any."""
    return describe(rows.select(F.size("relations").alias("n")).where("n > 0"), "n")


def relations_by_type(relations: DataFrame) -> DataFrame:
    return relations.groupBy("type").agg(F.count("*").alias("relations"))


def top_mentions(entities: DataFrame, k: int = 5) -> DataFrame:
    """Per type the most frequent lower-cased texts (ties by text).  Counts come first, so the window sees
    distinct texts only."""
    counts = entities.groupBy("type", F.lower("text").alias("text")).agg(F.count("*").alias("mentions"))
    rank = F.row_number().over(Window.partitionBy("type").orderBy(F.col("mentions").desc(), "text"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def top_relation_pairs(relations: DataFrame, k: int = 10) -> DataFrame:
    pair = F.concat(F.lower("chemical"), F.lit(" -> "), F.lower("disease")).alias("pair")
    return relations.groupBy(pair).agg(F.count("*").alias("relations")).orderBy(F.col("relations").desc(), "pair").limit(k)


# ---------------------------------------------------------------- tagged sentences
#: The integer tags.
TAGS = ("O", "B-GENE", "I-GENE")


def tag_name(tag: Column) -> Column:
    """Tag of an integer (unknown ones are O), or a tag that is a name already."""
    number = tag.try_cast("int") if hasattr(tag, "try_cast") else tag.cast("int")
    return F.when(number.isNull(), F.coalesce(tag.cast("string"), F.lit("O"))).otherwise(F.coalesce(F.get(F.array(*map(F.lit, TAGS)), F.when(number >= 0, number).otherwise(99)), F.lit("O")))


def tag_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("ner_tags").alias("t")).groupBy(tag_name(F.col("t")).alias("tag")).agg(F.count("*").alias("tokens"))


def iob_mentions(rows: DataFrame) -> DataFrame:
    """One row per mention: B opens, I goes on (or opens if nothing is open), else it ends; rows whose
    arrays differ in length are skipped.

    A sentence is written as one string, each token behind the letter of its tag and before an end mark
    (U+0002, which tokens must not hold); mentions are then matches of B or I and the I that follow.  This
    works inside the row, without a shuffle, and only mentions are exploded."""
    mark = "\x02"
    ok = rows.where(F.size("tokens") == F.size("ner_tags"))
    tagged = F.transform(F.arrays_zip("tokens", "ner_tags"), lambda x: F.concat(F.substring(tag_name(x["ner_tags"]), 1, 1), x["tokens"], F.lit(mark)))
    found = F.regexp_extract_all(F.array_join(tagged, ""), F.lit("(?:(?<=\x02)|^)[BI][^\x02]*\x02(?:I[^\x02]*\x02)*"), F.lit(0))
    m = ok.select("id", F.posexplode(found).alias("ordinal", "m"))
    parts = F.filter(F.split("m", mark), lambda p: p != "")
    return m.select("id", "ordinal", F.array_join(F.transform(parts, lambda p: F.substr(p, F.lit(2))), " ").alias("mention"), F.size(parts).alias("n_tokens"))


def iob_token_mentions(tokens: DataFrame) -> DataFrame:
    """iob_mentions of a long table: id, position (from 0), token, ner_tag, one row per token, for sequences that are no row.

    Tokens are dealt once, by sequence and range of positions, and a range finds its mentions on its own: only these
    are kept.  A mention's number gains those of the ranges before, and only mentions at the border of a range may be
    parts of one, so a sequence of any length is many tasks."""
    letter = F.substring(tag_name(F.col("ner_tag")), 1, 1)
    tag, inside = F.col("_tag"), F.col("_tag").isin("B", "I")
    here = Window.partitionBy("id", "_range").orderBy("position")
    rows = tokens.select("id", "position", "token", letter.alias("_tag"), F.floor(F.greatest("position", F.lit(0)) / scans.WIDTH).alias("_range"))
    rows = rows.withColumns({"_before": F.lag("_tag").over(here), "_last": F.lead("_tag").over(here).isNull()})
    opens = (tag == "B") | ((tag == "I") & ~F.coalesce(F.col("_before").isin("B", "I"), F.lit(False)))
    rows = rows.withColumn("_local", F.sum(opens.cast("int")).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where(inside | F.col("_before").isNull())  # a range's first token tells that there is a range
    part = Window.partitionBy("id", "_range", "_local").orderBy("position")
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = rows.withColumns({
        "_t": F.collect_list(F.when(inside, F.col("token"))).over(whole), "_joins": F.max(F.col("_before").isNull() & (tag == "I")).over(whole), "_ends": F.max(inside & F.col("_last")).over(whole), "_first": F.row_number().over(part) == 1,
    }).where("_first")
    parts = checkpointed(parts.select("id", "_range", "_local", "_t", "_joins", "_ends"))
    ranges = parts.groupBy("id", "_range").agg(F.max("_local").alias("_n"), F.max("_joins").alias("_j"), F.max("_ends").alias("_e"))
    by_range = Window.partitionBy("id").orderBy("_range")
    ranges = ranges.withColumn("_same", (F.col("_j") & F.coalesce(F.lag("_e").over(by_range), F.lit(False))).cast("int"))  # its first mention goes on from the range before
    ranges = ranges.withColumn("_add", F.sum(F.col("_n") - F.col("_same")).over(by_range) - F.col("_n")).where("_range > 0")
    later = parts.where("_range > 0").join(ranges.select("id", "_range", "_add"), ["id", "_range"])
    found = parts.where("_range = 0").withColumn("_add", F.lit(0).cast("long")).unionByName(later).where("_local > 0").withColumn("ordinal", (F.col("_local") + F.col("_add") - 1).cast("int"))
    border = F.col("_joins") | F.col("_ends")
    joined = found.where(border).groupBy("id", "ordinal").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_range", "_t"))), lambda x: x["_t"])).alias("_t"))
    every = found.where(~border).select("id", "ordinal", "_t").unionByName(joined)
    return every.select("id", "ordinal", F.array_join("_t", " ").alias("mention"), F.size("_t").alias("n_tokens"))


def mentions_per_sentence(rows: DataFrame, mentions: DataFrame) -> DataFrame:
    """describe of mentions per sentence, those without any included."""
    counts = mentions.groupBy("id").agg(F.count("*").alias("k"))
    return describe(rows.select("id").join(counts, "id", "left").select(F.coalesce("k", F.lit(0)).alias("mentions_here")), "mentions_here")


def mention_token_length(mentions: DataFrame) -> DataFrame:
    return describe(mentions, "n_tokens")
