import re

from pyspark.sql import functions as F

from spanloom.functions.identifiers import normalize_mesh, prediction_aliases
from spanloom.functions.text import has_text, strip, strip_quick
from spanloom.functions.vocab import normalize_entity_type
from spanloom.operators.keywords import keyword_mentions
from spanloom.operators.report_stats import annotator_comparison
from spanloom.plans import fixtures as X


def _method_size(spark, df):
    """The longest generated method; beyond 8000 the JVM interprets it row by row."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan())))


def test_quick_strip_is_strip(spark):
    chars = spark.range(1, 0x10000).where("id < 55296 OR id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32").alias("c"))
    texts = chars.select(F.explode(F.array("c", F.concat("c", F.lit("x")), F.concat(F.lit("x"), "c"), F.concat(F.lit("x"), "c", F.lit("y")))).alias("s"))
    texts = texts.unionByName(spark.createDataFrame([("",), (None,), ("😀 ",), ("  ",)], "s string"))
    assert texts.where(~strip_quick("s").eqNullSafe(strip("s"))).count() == 0
    assert texts.where(~has_text("s").eqNullSafe(strip("s") != "")).count() == 0


def test_methods_of_annotations_stay_short_enough_to_compile(spark, data):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _method_size(spark, X.annotations(spark, data)) < 8000
        assert _method_size(spark, X.gold_with_text(spark, data)) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_only_rows_that_are_asked_for_leave_python(spark, data):
    for df in (X.raw_predictions(spark, data), X.gold_with_text(spark, data)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Filter" not in plan and "around" not in plan


def test_keywords_deal_rows_once(spark, data):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for of in (keyword_mentions, annotator_comparison):
            plan = of(X.annotations(spark, data))._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2  # documents, then annotations by document
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_identifiers_and_types(spark):
    rows = [("mesh:D1",), ("MSH:D2",), ("A:",), (":x",), ("'OMIM: 7'",), ("-",), ("",), (None,), ("a;mim:b:c",), ("['ME:1', 'x']",)]
    df = spark.createDataFrame(rows, "v string").select("v", F.array_join(prediction_aliases("v"), "|"), normalize_mesh(F.col("v")))
    assert [tuple(r) for r in df.collect()] == [
        ("mesh:D1", "MESH:D1|D1", "MESH:D1"), ("MSH:D2", "MESH:D2|D2", "MSH:D2"), ("A:", "A", "A:"), (":x", ":X|X", ":x"), ("'OMIM: 7'", "OMIM:7|7", "'OMIM: 7'"), ("-", "", "-"), ("", "", ""), (None, "", None),
        ("a;mim:b:c", "A|OMIM:B:C|B:C", "a;mim:b:c"), ("['ME:1', 'x']", "MESH:1|1|X", "['ME:1', 'x']"),
    ]
    kinds = spark.createDataFrame([(" Cell-Line ",), ("__",), (None,), ("Other thing",), ("CHEMICAL",)], "t string").select(normalize_entity_type("t"))
    assert [r[0] for r in kinds.collect()] == ["cell_line", "unknown", "unknown", "other_thing", "drug"]
