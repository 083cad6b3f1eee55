"""Documents, corpora and id lists from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_pmid
from ..functions.text import blank_to_null, strip
from ..operators.corpus_stats import CORPUS_ROW, IOB_ROW
from ..operators.merge import numbered
from .json_ranges import RANGE_BYTES, read_json_elements


def _null(kind: str = "string"):
    return F.lit(None).cast(kind)


def read_text_table(spark: SparkSession, path: str, fmt: str, document_id: str = "document_id", title: str = "title", abstract: str = "abstract") -> DataFrame:
    """CSV or TSV with a header -> documents; other columns become metadata.

    An unknown format, a missing column or a blank id is an error."""
    if fmt.strip().lower() not in ("csv", "tsv"):
        raise ValueError(f"unsupported text table format: {fmt}")
    sep = "," if fmt.strip().lower() == "csv" else "\t"
    raw = spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True)
    if missing := [c for c in (document_id, title, abstract) if c not in raw.columns]:
        raise ValueError(f"{path} lacks required columns: {', '.join(missing)}")
    if not raw.where(blank_to_null(document_id).isNull()).isEmpty():
        raise ValueError(f"{path} holds a blank document id")
    extra = [c for c in raw.columns if c not in (document_id, title, abstract)]
    metadata = F.create_map(*(x for c in extra for x in (F.lit(c), F.coalesce(F.col(c), F.lit(""))))) if extra else F.create_map().cast("map<string,string>")
    text = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    return raw.select(strip(document_id).alias("document_id"), _null().alias("pmid"), text(title).alias("title"), text(abstract).alias("abstract"), _null().alias("full_text"), F.lit("text_table").alias("source"), _null().alias("year"), metadata.alias("metadata"))


_RECORD = "document_id string, pmid string, title string, abstract string, full_text string, source string, year string, metadata map<string,string>"


def read_corpus_json(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A JSON list of records, or an object with a documents list -> documents.

    Files are cut at element borders, range by range, so one long list is read by many tasks.  Compressed files and
    files in stores that only Spark can open are read whole, a file in a task."""
    record = "struct<" + ", ".join(x.replace(" ", ": ", 1) for x in _RECORD.split(", ")) + ">"
    elements = read_json_elements(spark, path, range_bytes=range_bytes)
    if elements is not None:
        return corpus_documents(elements.select("index", F.from_json("value", record).alias("r")).select("index", "r.*"))
    text = spark.read.text(path, wholetext=True)
    records, listed = F.from_json("value", f"array<{record}>"), F.from_json("value", f"struct<documents: array<{record}>>")["documents"]
    whole = F.when(F.rlike("value", F.lit(r"^\s*\[")), records).otherwise(listed)
    return corpus_documents(text.select(F.posexplode(whole).alias("index", "r")).select("index", "r.*"))


def corpus_documents(records: DataFrame) -> DataFrame:
    """records(index, document fields): blanks become null, ids fall back to the pmid, then to the index."""
    clean = {c: blank_to_null(c) for c in ("document_id", "pmid", "title", "abstract", "full_text", "source", "year")}
    df = records.withColumns(clean)
    document_id = F.coalesce("document_id", F.concat(F.lit("PMID:"), "pmid"), F.concat(F.lit("CORPUS:"), F.col("index").cast("string")))
    empty = F.lit("")
    return df.select(document_id.alias("document_id"), "pmid", F.coalesce("title", empty).alias("title"), F.coalesce("abstract", empty).alias("abstract"), "full_text", F.coalesce("source", F.lit("corpus")).alias("source"), "year", F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line; blank lines are dropped."""
    return spark.read.text(path).select(normalize_pmid("value").alias("pmid")).where("pmid IS NOT NULL")


def read_raw_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each non-empty line is a document text-<n>, n counted from 1 in the order of the file(s).

    Lines are numbered within their block of a file, which one task reads whole and in order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = numbered(lines.where(strip("value") != ""), ["i"], "n", [F.col("f"), F.col("b")])
    return lines.select(F.concat(F.lit("text-"), F.col("n") + 1).alias("document_id"), strip("value").alias("abstract"))


def read_bigbio_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Corpus rows with an explicit schema, so that nothing is read to infer one."""
    return spark.read.schema(CORPUS_ROW).json(path).where("document_id IS NOT NULL OR entities IS NOT NULL")


def read_iob_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IOB_ROW).json(path).where("tokens IS NOT NULL")
