"""Order lines are cleaned once a query, recent ones only where only they are wanted, and keys are made of parts without changing them."""

import re

import pytest
from pyspark.sql import functions as F

from bloomline.functions import text as t
from bloomline.operators import analysis, structures, views
from bloomline.plans import analysis_queries, cluster_queries, cluster_report_queries, order_queries, reading_queries, structure_queries  # noqa: F401
from bloomline.plans.fixtures import history
from bloomline.plans.registry import QUERIES
from bloomline.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df) -> int:
    """How often the lines of the star schema are read when the result is asked for."""
    return len(re.findall(r"Relation \[[^\]]*l_orderkey", plan(df)))


@pytest.mark.parametrize(
    ("name", "most"),
    [("client_week_sku", 0), ("stem_conservation_audit", 0), ("structure_boxes", 1), ("structure_components", 1), ("operational_demand_summary", 1), ("combine_demand", 1), ("cluster_names", 0)],
)
def test_lines_are_cleaned_once(spark, sf_dir, name, most):
    assert scans(QUERIES[name](spark, sf_dir)) <= most


@pytest.mark.parametrize("recent", [lambda df: views.sku_summary(df), lambda df: analysis.recent_sku_history(df), lambda df: structures.lately(df, 12)])
def test_old_lines_are_not_read(spark, sf_dir, recent):
    assert re.search(r"Filter .*o_orderdate#\d+( as date\))? >= ", plan(recent(history(spark, sf_dir))))


def test_lately_of_no_lines(spark):
    df = spark.createDataFrame([], "order_date date, x int")
    assert structures.lately(df, 4).count() == 0


def test_stored_lines_are_not_written_again(spark):
    first = tables.stored_once(spark.range(5).withColumn("x", F.col("id") * 2), ["id", "x"], "once")
    again = tables.stored_once(first, ["x"], "once")
    assert sorted(again.inputFiles()) == sorted(first.inputFiles())
    assert sorted(r.x for r in again.collect()) == [0, 2, 4, 6, 8]


def test_stream_writes_what_is_asked_for(spark, sf_dir):
    files = QUERIES["clean_orders_stream"](spark, sf_dir).inputFiles()
    assert set(spark.read.parquet(*files).columns) <= {"product", "order_type", "state_canonical", "stems"}


def test_untidy_texts(spark):
    cases = ["A  b", "a\tb", " a", "a ", "NaN", "nAn", " nan ", "a ́ b", "\x0b", "Sólido", "USD", "a\nb\r"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string").orderBy("i")
    got = [r.y for r in df.select(t.normalize_text(F.col("x")).alias("y")).collect()]
    assert got == ["a b", "a b", "a", "a", "sin_info", "sin_info", "sin_info", "a b", "sin_info", "solido", "usd", "a b"]


def test_keys_of_parts_are_keys_of_the_joined_text(spark):
    rows = [("rojo / azul", "12.5", "x"), ("日本", "--", "x"), ("_a_", None, "b  c"), ("%%", "日", "!"), ("sin_info", "", "a__b")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    joined = F.lower(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("sin_info")) for c in "abc"]))
    whole = F.btrim(F.regexp_replace(joined, "[^a-z0-9]+", "_"), F.lit("_"))
    want = F.when(whole == "", "sin_info").otherwise(whole)
    for r in df.select(t.combine_key("a", "b", "c").alias("mine"), want.alias("want")).collect():
        assert r.mine == r.want
