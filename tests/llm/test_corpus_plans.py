"""Plans of the corpus operators: native where asked for, no cross joins, no shuffle of rows."""

import pytest
from pyspark.sql import functions as F

from flowtables.llm import decontaminate, license_scan, line_dedup, mixing, quality_rules
from tests.llm.test_corpus_edges import frame, prose


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, [prose(i % 7) for i in range(20)])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "operator", [quality_rules.judge, license_scan.scan, line_dedup.dedup_lines, mixing.mix_sources]
)
def test_native_operators(docs, operator):
    text = plan(operator(docs))
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_row_wise_operators_do_not_shuffle(spark, docs):
    bench = spark.createDataFrame([(1, prose(3))], "item_id bigint, text string")
    for df in (license_scan.scan(docs), decontaminate.contaminations(docs, bench)):
        assert "Exchange" not in plan(df)


def test_mixing_cuts_hot_sources_into_ranges(spark, docs):
    one = docs.withColumn("source", F.lit("hot"))
    windows = [x for x in plan(mixing.mix_sources(one)).split("\n") if "Window [" in x]
    assert windows and all("_range" in x for x in windows)
