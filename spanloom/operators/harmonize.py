"""Spans of any annotator become one annotation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import sanitize
from ..functions.text import pieces, slice_pieces, slice_text, strip, strip_quick
from ..functions.vocab import ANNOTATORS, normalize_entity_type

ANNOTATION = "document_id string, annotation_id string, source string, span_text string, start int, end int, entity_type string, canonical_id string, canonical_name string, confidence double, ordinal int, source_rank int"
#: The order in which annotators' outputs follow each other; it decides which surface of a keyword comes first.
SOURCE_ORDER = ("bern2", "flair", "pubtator3", "aioner", "bent", "apollo", "clinicalbert", "biobert", "d4data", "medcat", *(a for a in ANNOTATORS if a.startswith("scispacy_")), *(a for a in ANNOTATORS if a.startswith("stanza_")))


def annotation_id(source: Column, document_id: Column, entity_type: Column, start: Column, end: Column, span: Column) -> Column:
    text = [F.coalesce(x.cast("string"), F.lit("None")) for x in (start, end)]
    return F.concat(source, F.lit(":"), F.substring(F.sha1(F.concat_ws("|", source, document_id, entity_type, *text, span)), 1, 12))


def resolve_offsets(text: Column, span: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """Both offsets as given, else those of the first occurrence of the span, else none."""
    given = start.isNotNull() & end.isNotNull()
    found = F.instr(text, span)
    found = F.when(F.length(span) > 0, F.nullif(found, F.lit(0)) - 1)
    return F.when(given, start).otherwise(found).cast("int"), F.when(given, end).otherwise(found + F.length(span)).cast("int")


#: Characters between the parts of a text, and characters of a part: a span of at most PART - STEP of them lies in one.
STEP, PART = 1024, 1280


def with_span_text(spans: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """spans(key, start, end, ...) + span_text, cut out of documents(key, text).

    Spans meet a part of the text that begins shortly before them, not the whole text: cutting then costs the
    span's length instead of its position, no row carries a text, and a long document is many join keys.  Spans
    longer than a part are cut out of the whole text, which stands under a part number of its own."""
    c, n = F.explode(F.sequence(F.lit(-1).cast("long"), F.floor(F.length("text") / STEP))), F.col("_part")
    texts = documents.select(key, "text", c.alias("_part"))
    parts = texts.select(key, "_part", F.when(n < 0, F.col("text")).otherwise(F.substr("text", n * STEP + 1, F.lit(PART))).alias("_text"))
    whole = (F.col("end") - F.col("start") > PART - STEP) | (F.col("start") < 0)
    rows = spans.withColumn("_part", F.when(whole, -1).otherwise(F.floor(F.col("start") / STEP)).cast("long"))
    at = F.when(F.col("_part") < 0, F.col("start")).otherwise(F.col("start") - F.col("_part") * STEP).cast("int")
    joined = rows.join(parts, [key, "_part"])
    return joined.withColumn("span_text", slice_text("_text", at, at + (F.col("end") - F.col("start")))).drop("_part", "_text")


def make_annotations(spans: DataFrame, text_col: str | None = None) -> DataFrame:
    """spans(document_id, source, span_text, entity_type, start, end, canonical_id, canonical_name,
    confidence, ordinal, source_rank[, text]) -> annotations, in one projection.

    With text_col missing offsets are looked up; it is dropped afterwards."""
    span = strip("span_text") if text_col else strip_quick("span_text")
    start, end = resolve_offsets(F.col(text_col), span, F.col("start"), F.col("end")) if text_col else (F.when(F.col("end").isNotNull(), F.col("start")).cast("int"), F.when(F.col("start").isNotNull(), F.col("end")).cast("int"))
    df = spans.withColumns({"_span": span, "_start": start, "_end": end, "_type": normalize_entity_type("entity_type")})
    confidence = F.col("confidence") if dict(spans.dtypes)["confidence"] == "double" else F.expr("try_cast(confidence AS double)")
    return df.select(
        "document_id", annotation_id(F.col("source"), F.col("document_id"), F.col("_type"), F.col("_start"), F.col("_end"), F.col("_span")).alias("annotation_id"), "source", F.col("_span").alias("span_text"),
        F.col("_start").alias("start"), F.col("_end").alias("end"), F.col("_type").alias("entity_type"), sanitize("canonical_id").alias("canonical_id"), sanitize("canonical_name").alias("canonical_name"),
        confidence.alias("confidence"), F.col("ordinal").cast("int").alias("ordinal"), F.col("source_rank").cast("int").alias("source_rank"),
    )


def flatten_annotations(*outputs: DataFrame, order: tuple[str, ...] = SOURCE_ORDER) -> DataFrame:
    """All annotators' rows in one table with their rank in the fixed order; unlisted sources are dropped."""
    df = outputs[0]
    for more in outputs[1:]:
        df = df.unionByName(more)
    return df.withColumn("source_rank", (F.array_position(F.array(*map(F.lit, order)), F.col("source")) - 1).cast("int")).where("source_rank >= 0")


def filter_by_type(annotations: DataFrame, entity_types: list[str]) -> DataFrame:
    """Rows of the requested types, both sides normalised; an empty request keeps all."""
    if not entity_types:
        return annotations
    asked = F.array(*(normalize_entity_type(F.lit(t)) for t in entity_types))
    return annotations.where(F.array_contains(asked, normalize_entity_type("entity_type")))


def min_confidence(annotations: DataFrame, threshold: float | None, default: float | None = None) -> DataFrame:
    """Rows of at least the threshold; none given means the default, zero or less means no filter."""
    limit = default if threshold is None else threshold
    return annotations if limit is None or limit <= 0 else annotations.where(F.expr("try_cast(confidence AS double)") >= limit)


def validated(annotations: DataFrame, documents: DataFrame) -> DataFrame:
    """annotations + offsets_ok, text_ok: the offsets lie in the canonical text and cut out the span.

    A text is measured and cut into pieces once, so that a span costs its length, not its position or the text's."""
    df = annotations.join(documents.select("document_id", "text", F.length("text").alias("_n"), pieces("text").alias("_pieces")), "document_id", "left")
    ok = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("_n"))
    same = slice_pieces("_pieces", "text", "start", "end") == F.col("span_text")
    return df.withColumn("offsets_ok", F.coalesce(ok, F.lit(False))).withColumn("text_ok", F.coalesce(ok & same, F.lit(False))).drop("text", "_n", "_pieces")


def split_regions(annotations: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows inside the title or the abstract, with region and offsets within it; others are dropped."""
    n = F.length(F.coalesce(strip("title"), F.lit("")))
    df = annotations.join(documents.select("document_id", n.alias("_n")), "document_id").where("start IS NOT NULL AND end IS NOT NULL")
    body = F.when(F.col("_n") > 0, F.col("_n") + 2).otherwise(0)
    region = F.when((F.col("_n") > 0) & (F.col("end") <= F.col("_n")), "title").when(F.col("start") >= body, "abstract")
    df = df.withColumn("region", region).where("region IS NOT NULL")
    shift = F.when(F.col("region") == "abstract", body).otherwise(0)
    return df.withColumn("start", F.col("start") - shift).withColumn("end", F.col("end") - shift).drop("_n")
