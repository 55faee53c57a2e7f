"""Shapes of the physical plans that decide how far a query scales."""

import pytest

from checks.inputs import dims, raw_results
from checks.queries import QUERIES
from labweave.operators import matching, measures
from labweave.plans import pipeline
from labweave.sources.config import dims_from_folder
from labweave.sources.files import read_files
from tests import sample
from tests.test_queries import SF, pytestmark  # noqa: F401


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_classifying_rows_never_shuffles_them(spark):
    text = plan(QUERIES["classify"](spark, SF))
    rows = text[:text.index("InMemoryRelation")] if "InMemoryRelation" in text else text
    assert "BroadcastHashJoin" in rows
    assert "Exchange hashpartitioning" not in rows and "SortMergeJoin" not in rows


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(QUERIES["classify"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text
    text = plan(QUERIES["latest_per_key"](spark, SF))
    assert "o_comment" not in text


def test_filters_reach_the_scan(spark):
    text = plan(raw_results(spark, SF).filter("event_id > 500 and doc = 3"))
    assert "GreaterThan(event_id,500)" in text and "EqualTo(user_id,3)" in text


def test_a_filter_on_exclusion_does_not_repeat_the_parsing(spark):
    rows = raw_results(spark, SF).withColumnsRenamed({"result": "result_text", "unit": "unit_original"})
    named = matching.match_names(rows, "raw_name", dims(spark), spread=["event_id"])
    text = plan(measures.measure(named, dims(spark)).filter("not exclude"))
    assert "Filter" in text
    for line in text.splitlines():
        if " Filter " in line or line.strip().startswith(("Filter", "+- Filter")):
            assert "regexp" not in line.lower() and "rlike" not in line.lower()


def longest_method(df) -> int:
    """Bytes of bytecode of the longest method that Spark makes of a plan's stages."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


def test_the_jvm_compiles_every_stage_of_the_rows(spark, tmp_path, monkeypatch):
    """Methods of more than 8,000 bytes are interpreted."""
    source, config = sample.write_reports(tmp_path / "in"), sample.write_config(tmp_path / "config")
    kept, longest = pipeline.checkpoint, {}

    def measured(df, name="stage", **options):
        longest[name] = longest_method(df)
        return kept(df, name, **options)

    monkeypatch.setattr(pipeline, "checkpoint", measured)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # whose stages are made only as it runs
    try:
        pipeline.process(read_files(spark, source), dims_from_folder(spark, config))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert 0 < min(longest.values()) and max(longest.values()) <= 8_000, longest


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_pairs_all_rows(spark, name):
    """No cross join and no nested loop over two tables."""
    if name.startswith("streamed"):
        return
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
