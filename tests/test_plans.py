"""Plans stay what they should be: one parse, hash aggregation, pruned scans, no Python."""

import pytest
from samplelog import LINES

from pulselog import operators as ops
from pulselog import schema
from pulselog.plans import QUERIES
from pulselog.sources import parse_events, read_events


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if "stream" in n}))
def test_no_python_and_no_sort_aggregation(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    assert "SortAggregate" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("render", [ops.records, ops.exposition_text, ops.kafka_rows])
def test_lines_are_parsed_once(spark, render):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    events = parse_events(lines, schema.BASIC_KINDS)
    text = plan(render(events))
    assert text.count("from_json") == 1
    assert "Exchange" not in text
    assert plan(ops.record_table(events, "jobs_started")).count("from_json") == 1


def test_rendering_is_not_evaluated_twice(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    text = plan(ops.kafka_rows(parse_events(lines, schema.BASIC_KINDS)))
    assert text.count("queries_ended") == 1


def test_log_scan_is_filtered_and_pruned(spark, tmp_path):
    (tmp_path / "app-1").write_text("\n".join(LINES), encoding="utf-8")
    pruned = "ReadSchema: struct<Event:string,Job ID:bigint,Submission Time:bigint>"
    whole = plan(ops.record_table(read_events(spark, str(tmp_path)), "jobs_started"))
    assert "In(Event, [" in whole and pruned in whole
    kind = ("jobs_started",)
    narrow = plan(ops.record_table(read_events(spark, str(tmp_path), kind), "jobs_started"))
    assert "EqualTo(Event,SparkListenerJobStart)" in narrow and pruned in narrow


def test_tasks_are_summed_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["stage_rollup"](spark, sf_dir))
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning(appId")


def test_top_words_keep_only_the_top(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=20" in plan(QUERIES["word_count_top"](spark, sf_dir))
