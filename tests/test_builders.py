"""Connectors, persistent queries, table syncs, usage and the edge table."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tributary.operators import connect, edges, ksql, tableflow, usage
from tributary.plans import cycle as plan

CONN = "name string, type string, status string, config map<string,string>, env_id string, cluster_id string, connect_cluster string"


def connectors(spark, *items):
    return spark.createDataFrame(list(items), CONN)


def test_topic_bindings(spark):
    df = connectors(
        spark,
        ("s1", "source", "RUNNING", {"kafka.topic": "ol-raw"}, "e", None, None),
        ("s2", "source", "PAUSED", {"kafka.topic": "", "topic": "b"}, "e", None, None),
        ("s3", "source", "RUNNING", {"topics": "not-for-sources"}, "e", None, None),
        ("k1", "sink", "FAILED", {"topics": "topic-a, topic-b,,  topic-c "}, "e", None, None),
        ("k2", "sink", "RUNNING", {"topics": "", "kafka.topics": "x"}, "e", None, None),
        ("k3", "sink", "RUNNING", {}, "e", None, None),
        ("o", "other", "RUNNING", {"topic": "x"}, "e", None, None),
    )
    assert rows(connect.connector_topics(df), "name", "pos", "topic") == [
        ("k1", 0, "topic-a"), ("k1", 1, "topic-b"), ("k1", 2, "topic-c"), ("k2", 0, "x"),
        ("s1", 0, "ol-raw"), ("s2", 0, "b"),
    ]


def test_connector_edges_and_namespaces(spark, env_dim):
    df = connectors(
        spark,
        ("s", "source", "PAUSED", {"kafka.topic": "t"}, "env-a", "lkc-a", None),
        ("k", "sink", "UNASSIGNED", {"topics": "t"}, None, None, "on-prem"),
    )
    got = edges.lineage_edges([connect.connector_edges(df)], env_dim)
    assert rows(got, "job_namespace", "job_type", "source_name", "source_type", "target_name", "target_type", "region") == [
        ("kafka-connect://env-a", "kafka_connect_source", "s", "external", "t", "kafka_topic", "us-east-2"),
        ("kafka-connect://on-prem", "kafka_connect_sink", "t", "kafka_topic", "k", "external", None),
    ]


def test_ksql_resolution(spark):
    sources = spark.createDataFrame([("c1", "MY_STREAM", "topic-x")], "ksql_cluster_id string, name string, topic string")
    queries = spark.createDataFrame([
        ("q1", "c1", "running", ["out"], ["my_stream", "OTHER"]),
        ("q2", "c2", "RUNNING", ["out"], ["my_stream"]),
        ("q3", "c1", "RUNNING", ["topic-x"], ["MY_STREAM"]),
        ("q4", "c1", "PAUSED", ["out"], ["MY_STREAM"]),
        ("q5", "c1", "RUNNING", [], ["MY_STREAM"]),
    ], "query_id string, ksql_cluster_id string, state string, sink_topics array<string>, sources array<string>")
    assert rows(ksql.ksql_edges(queries, sources), "job_name", "source_name", "target_name", "job_namespace") == [
        ("q1", "OTHER", "out", "ksqldb://c1"), ("q1", "topic-x", "out", "ksqldb://c1"),
        ("q2", "my_stream", "out", "ksqldb://c2"),
    ]


def test_tableflow(spark):
    df = spark.createDataFrame(
        [("e", "a-b", "RUNNING"), ("e", "c", "disabled"), ("e", "d", "SUSPENDED"), ("e", "x", "Deleted")],
        "env_id string, topic_name string, status string")
    assert rows(tableflow.tableflow_edges(df), "source_name", "target_name", "target_namespace") == [
        ("a-b", "a_b", "iceberg://tableflow"), ("d", "d", "iceberg://tableflow")]
    assert rows(tableflow.tableflow_edges(df, "r1", "db"), "target_name", "target_namespace") == [
        ("db.a_b", "glue://r1"), ("db.d", "glue://r1")]
    assert rows(tableflow.tableflow_edges(df, "r1", ""), "target_namespace")[0] == ("iceberg://tableflow",)


METRIC = "cluster_id string, metric string, ts timestamp, topic string, consumer_group_id string, client_id string, value double"


def metrics(spark, items):
    return spark.createDataFrame(items, "cluster_id string, metric string, topic string, consumer_group_id string, client_id string, value double").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_bindings(spark):
    lag, recv = "consumer_lag_offsets", "received_bytes"
    df = metrics(spark, [
        ("c", lag, "t2", "app", "", 0.0), ("c", lag, "t1", "app", "", None), ("c", lag, "t1", "app", "", 5.0),
        ("c", lag, "t1", "_schemas", "", 1.0), ("c", lag, "t1", "confluent_cli_consumer_abc", "", 1.0),
        ("c", lag, "t1", "connect-jdbc", "", 1.0), ("c", lag, "", "app", "", 1.0), ("c", lag, "t1", None, "", 1.0),
        ("c", recv, "t1", "", "svc", 1.0), ("c", recv, "t1", "", "connector-producer-1", 1.0),
        ("c", recv, "t1", "", "_confluent-flink_x", 1.0), ("c", recv, "t1", "", "connector-x", 1.0),
        ("c", recv, None, "", "svc", 1.0), ("d", recv, "t1", "", "svc", 1.0),
    ])
    assert rows(usage.consumer_groups(df)) == [("c", "app", "t1"), ("c", "app", "t2"), ("c", "connect-jdbc", "t1")]
    assert rows(usage.consumer_groups(df, ("app",))) == [("c", "connect-jdbc", "t1")]
    assert rows(usage.producers(df)) == [("c", "svc", "t1"), ("d", "svc", "t1")]


def test_throughput_truncates_each_value_and_keeps_zero_topics(spark):
    df = metrics(spark, [
        ("c", "received_bytes", "t", "", "", 1.9), ("c", "received_bytes", "t", "", "", 1.9),
        ("c", "sent_records", "t", "", "", -1.9), ("c", "sent_bytes", "z", "", "", 0.0),
        ("c", "sent_bytes", "n", "", "", None), ("c", "sent_bytes", "", "", "", 7.0),
        ("c", "consumer_lag_offsets", "lag-only", "", "", 7.0),
    ])
    assert rows(usage.topic_throughput(df)) == [("c", "t", 2, 0, 0, -1, 10), ("c", "z", 0, 0, 0, 0, 10)]


def test_lookback_is_half_open_and_minute_aligned(spark):
    df = spark.createDataFrame([("11:49:59",), ("11:50:00",), ("11:59:59",), ("12:00:00",), ("12:00:20",)], "t string")
    df = df.select("t", F.concat(F.lit("2024-01-01 "), "t").cast("timestamp").alias("ts"))
    as_of = F.lit("2024-01-01 12:00:30").cast("timestamp")
    assert rows(usage.lookback(df, as_of, 10), "t") == [("11:50:00",), ("11:59:59",)]


def test_a_cycle_counts_its_window_only(spark, env_dim):
    rows_ = [("lkc-a", "received_bytes", "t", "", f"p{i}", 5.0, at) for i, at in enumerate(("2023-11-01 00:00:00", "2024-01-01 11:55:00", "2024-01-01 12:00:10"))]
    df = spark.createDataFrame(rows_, "cluster_id string, metric string, topic string, consumer_group_id string, client_id string, value double, at string")
    inv = plan.Inventory(env_dim=env_dim, metrics=df.withColumn("ts", F.col("at").cast("timestamp")).drop("at"))
    graph = plan.build_graph(inv, plan.Options(as_of="2024-01-01 12:00:30"))
    assert rows(graph.topic_throughput, "topic", "bytes_in") == [("t", 5)] and rows(graph.producers, "client_id") == [("p1",)]
    assert rows(plan.build_graph(inv).topic_throughput, "bytes_in") == [(15,)]


def test_prefix_anti_join_equals_startswith(spark):
    ids = ["", "a", "ab", "abc", "b", "bcd", None] + [f"id{i}" for i in range(60)]
    prefixes = ["ab", "bcde", "id1", "id22"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "n int, who string")
    pre = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    want = sorted(i for i, v in enumerate(ids) if v is None or not any(v.startswith(p) for p in prefixes))
    assert sorted(r.n for r in usage.prefix_anti_join(df, pre, "who").collect()) == want
    assert usage.prefix_anti_join(df, pre.limit(0), "who").count() == len(ids)
    # Ids are cut to the lengths of prefixes only.
    cut = usage.id_cuts(df.where("who IS NOT NULL").select(F.col("who").alias("_id")), [2, 3, 4], 16)
    assert cut.count() == sum(len(v) >= n for v in ids if v is not None for n in (2, 3, 4))
    everything = spark.createDataFrame([("",)], "prefix string")
    assert [r.n for r in usage.prefix_anti_join(df, everything, "who").collect()] == [6]


@pytest.mark.parametrize("host,want", [
    ("pkc-921jm.us-east-2.aws.confluent.cloud:9092", ("aws", "us-east-2")),
    ("lkc-1.pkc-2.europe-west1.gcp.confluent.cloud", ("gcp", "europe-west1")),
    ("us-east-2.aws.confluent.cloud:9092", ("", "")), ("localhost:9092", ("", "")), ("", ("", "")), (None, ("", "")),
])
def test_cloud_region(spark, host, want):
    from tributary.functions.identity import cloud_region

    c, r = cloud_region(F.col("h"))
    assert tuple(spark.createDataFrame([(host,)], "h string").select(c, r).first()) == want


def test_edge_order_is_total_and_scopes_come_in_order(spark, env_dim):
    df = connectors(
        spark, ("z", "source", "R", {"topic": "t1,t2"}, "env-b", "lkc-b", None),
        ("a", "source", "R", {"topic": "t1"}, "env-a", "lkc-a", None), ("m", "sink", "R", {"topics": "t"}, None, None, "own"))
    got = edges.lineage_edges([connect.connector_edges(df)], env_dim).orderBy("edge_seq").collect()
    assert [(r.job_name, r.target_name) for r in got] == [("m", "m"), ("a", "t1"), ("z", "t1"), ("z", "t2")]


def test_summary_counts_before_activity_filters(spark, env_dim):
    statements = spark.createDataFrame(
        [("a", "env-a", "RUNNING", "INSERT INTO o SELECT * FROM i"), ("b", "env-a", "FAILED", "x")],
        "name string, env_id string, status string, sql_text string")
    counts, listing = plan.validate(plan.Inventory(env_dim=env_dim, statements=statements))
    got = counts.first().asDict()
    assert got["flink_statements"] == 2 and got["edges"] == 1 and got["consumer_groups"] == 0
    assert rows(listing) == [("a", "flink_statement", "i", "o")]
