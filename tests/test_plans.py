"""What the plans must and must not contain."""

import os

import pytest

from tributary.operators import diff, events, graph, statements, usage
from tributary.plans import registered
from tributary.sources.adaptors import Landed
from tributary.streaming import usage as stream_usage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "BatchEval")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark):
    return Landed(spark, SF)


BATCH = {
    "edges": lambda t: registered._edges(t),
    "datasets": lambda t: events.event_datasets(registered._edges(t)),
    "jobs": lambda t: events.job_events(events.event_datasets(registered._edges(t))),
    "throughput": lambda t: usage.topic_throughput(t.metric_rows()),
    "groups": lambda t: usage.consumer_groups(t.metric_rows()),
    "history": lambda t: diff.diff_history(t.job_history(), t.source_health()),
    "diff": lambda t: diff.diff_cycle(*registered._cycle_inputs(t)),
    "prefixes": lambda t: usage.prefix_anti_join(t.metric_rows(), t.table("supplier").selectExpr("s_name AS prefix"), "client_id"),
    "dependencies": lambda t: graph.job_dependencies(events.event_datasets(registered._edges(t))),
}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_all_pairs(landed, name):
    text = physical(BATCH[name](landed))
    assert not [w for w in FORBIDDEN if w in text]


def test_statement_edges_need_no_shuffle(landed):
    assert "Exchange" not in physical(statements.flink_edges(landed.flink_statements()))


def test_columns_are_pruned(landed):
    text = physical(usage.consumer_groups(landed.metric_rows()))
    assert "props" not in text and "event_type" not in text


def test_aggregates_combine_before_the_shuffle(landed):
    text = physical(usage.topic_throughput(landed.metric_rows()))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1
    jobs = physical(events.job_events(events.event_datasets(registered._edges(landed))))
    # Below the exchange that brings a job's rows together, they have been added up.
    assert "partial_" in jobs[jobs.index("Exchange hashpartitioning"):]


def test_cycle_filter_prunes_partitions(spark, landed, tmp_path):
    path = str(tmp_path / "history")
    landed.job_history().write.partitionBy("cycle").parquet(path)
    text = physical(spark.read.parquet(path).where("cycle = 1998"))
    assert "PartitionFilters: [isnotnull(cycle" in text


def test_sliding_totals_copy_panes_not_rows(landed):
    text = physical(stream_usage.sliding_throughput(landed.metric_rows()))
    assert "Expand" not in text
    # The copies are made of sums: below the generator there is a whole aggregate.
    assert text.index("Generate") < text.rindex("Exchange hashpartitioning")


def test_topology_of_jobs_sorts_no_edges(landed):
    text = physical(events.job_topology(registered._edges(landed)))
    assert "SortAggregate" not in text and "HashAggregate" in text
    # Edges are one row for each job and topology before they travel.
    assert "partial_min" in text[text.index("Exchange hashpartitioning"):]
