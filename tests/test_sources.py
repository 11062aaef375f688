"""Landed payloads as the platforms send them, and the table sinks."""

import json

import pytest
from conftest import rows

from tributary.plans import cycle as plan
from tributary.sources import inventory, tables, wire


def land(tmp_path, folder, *documents):
    target = tmp_path / folder
    target.mkdir(parents=True)
    (target / "doc.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(tmp_path / folder.split("/")[0])


def test_connectors(spark, tmp_path):
    doc = {"a": {"info": {"type": "SINK", "config": {"topics": "x,y", "tasks.max": 3}}, "status": {"connector": {"state": "RUNNING"}}}, "b": {}}
    managed = inventory.read_connect_inventory(spark, land(tmp_path, "m/env_id=env-1/cluster_id=lkc-1", doc))
    assert rows(managed, "id", "status", "type", "env_id", "connect_cluster") == [
        ("lkc-1:a", "RUNNING", "sink", "env-1", None), ("lkc-1:b", "UNKNOWN", "source", "env-1", None)]
    own = inventory.read_connect_inventory(spark, land(tmp_path, "s/connect_cluster=on-prem", doc))
    assert rows(own, "id", "connect_cluster")[0] == ("on-prem:a", "on-prem")


def test_pretty_printed_documents(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "d.json").write_text(json.dumps([{"name": "s", "statement": "SELECT 1"}, {"name": "", "statement": "x"}, {"name": "n"}], indent=2))
    got = inventory.read_flink_statements(spark, str(tmp_path / "p"), whole_files=True)
    assert rows(got, "name", "status", "sql_text", "compute_pool") == [("s", "UNKNOWN", "SELECT 1", "")]


def test_metric_pages_concatenate(spark, tmp_path):
    pages = [{"data": [{"metric.topic": "t", "value": 1.5}], "meta": {"pagination": {"page_token": "x"}}},
             {"data": [{"metric.topic": "u", "metric.client_id": "c", "value": None}]}, {"data": []}, {}]
    got = inventory.read_metric_rows(spark, land(tmp_path, "mm/cluster_id=lkc-1/metric=sent_bytes", *pages))
    assert rows(got, "cluster_id", "metric", "topic", "client_id", "value") == [
        ("lkc-1", "sent_bytes", "t", None, 1.5), ("lkc-1", "sent_bytes", "u", "c", None)]


def test_ksql_sources_last_wins(spark, tmp_path):
    def d(*pairs):
        return [{"sourceDescriptions": [{"name": n, "topic": t} for n, t in pairs]}]
    land(tmp_path, "k/ksql_cluster_id=c/kind=streams", d(("my_stream", "t1"), ("x", ""), ("MY_STREAM", "t2"), ("both", "s")))
    path = land(tmp_path, "k/ksql_cluster_id=c/kind=tables", d(("Both", "t")))
    assert rows(inventory.read_ksql_sources(spark, path)) == [("c", "BOTH", "t"), ("c", "MY_STREAM", "t2")]


def test_ksql_queries(spark, tmp_path):
    docs = [{"queries": [
        {"id": {"queryId": "q1"}, "state": "RUNNING", "sinkKafkaTopics": ["t"], "sinks": ["S"], "sources": ["A"]},
        {"id": {"queryId": "q2"}, "sinkKafkaTopics": [], "sinks": ["S"]}, {"id": None}, {"id": {"queryId": ""}}, {"id": {"queryId": "q3"}}]}, {}]
    got = inventory.read_ksql_queries(spark, land(tmp_path, "q/ksql_cluster_id=c", docs))
    assert [(r.query_id, r.state, r.sink_topics, r.sources) for r in got.orderBy("query_id").collect()] == [
        ("q1", "RUNNING", ["t"], ["A"]), ("q2", "UNKNOWN", ["S"], []), ("q3", "UNKNOWN", [], [])]


def test_topics(spark, tmp_path):
    flow = inventory.read_tableflow_topics(spark, land(tmp_path, "t/env_id=e", [
        {"topic_name": "a", "phase": "RUNNING"}, {"display_name": "b", "status": "X"}, {"topic_name": "", "name": "c"}, {"phase": "RUNNING"}]))
    assert rows(flow) == [("e", "a", "RUNNING"), ("e", "b", "X"), ("e", "c", "UNKNOWN")]
    meta = inventory.read_topic_metadata(spark, land(tmp_path, "d/cluster_id=c", {"data": [
        {"topic_name": "a", "partitions_count": 6, "replication_factor": 3, "is_internal": True}, {"topic_name": "b"}, {"partitions_count": 1}]}))
    assert rows(meta) == [("c", "a", 6, 3, True), ("c", "b", 0, 0, False)]


BROKEN = ['[{"name": "s", "statement": "SELECT 1"}, {"na', '{"error_code": 401, "message": "no"}', "<html>", "null", "5", '[1, 2]', '[{"name": "s"}, null]', "[] trailing"]


def test_broken_documents_are_counted_and_give_no_rows(spark, tmp_path):
    good = '[{"name": "s", "statement": "SELECT 1"}]'
    for env, docs in {"a": [good], "b": [good, "", "  ", BROKEN[0]], "c": ["[]"], "d": BROKEN}.items():
        (tmp_path / "f" / f"env_id={env}").mkdir(parents=True)
        (tmp_path / "f" / f"env_id={env}" / "x.json").write_text("\n".join(docs))
    path = str(tmp_path / "f")
    docs = inventory.parsed(spark, path, "flink")
    assert rows(inventory.payload_health(docs, "flink")) == [
        ("flink://a", "flink", True, 1, 0), ("flink://b", "flink", False, 2, 1), ("flink://c", "flink", True, 1, 0), ("flink://d", "flink", False, 8, 8)]
    assert rows(inventory.read_flink_statements(spark, docs), "env_id") == rows(inventory.read_flink_statements(spark, path), "env_id") == [("a",), ("b",)]


@pytest.mark.parametrize("source, context, namespace, whole, broken", [
    ("connect", "env_id=e/connect_cluster=on-prem", "kafka-connect://on-prem", ['{}', '{"a": {}}', '{"a": {"info": {"type": 5}}}'], ['[]', '{"a": null}', '{"error_code": 5}', '{"a": {}']),
    ("connect", "env_id=e", "kafka-connect://e", ['{"a": {}}'], [' \n']),
    ("metrics", "cluster_id=c/metric=received_bytes", "kafka-producer://c", ['{}', '{"data": []}', '{"data": [{"value": 1}], "meta": {}}'], ['{"errors": []}', '{"data": {"x": 1}}', '{"data": [{"value": "x"}]}', '[]']),
    ("metrics", "cluster_id=c/metric=consumer_lag_offsets", "kafka-consumer-group://c", ['{"data": []}'], ['{"data": [}']),
    ("metrics", "cluster_id=c/metric=sent_bytes", None, ['{"data": []}'], ['no']),
    ("ksql_queries", "ksql_cluster_id=k", "ksqldb://k", ['[{}]', '[{"queries": []}]'], ['{"queries": []}']),
    ("ksql_sources", "ksql_cluster_id=k/kind=tables", "ksqldb://k", ['[{"sourceDescriptions": null}]'], ['["x"]']),
    ("tableflow", "env_id=e", "tableflow://e", ['[]'], ['{}']),
    ("metadata", "cluster_id=c", None, ['{"data": []}'], ['{"error": "x"}']),
    ("subjects", "env_id=e", None, ['{"subject": "s"}'], ['{"subject": "s"']),
    ("environments", "", None, ['{"environments": []}'], ['{"environments": 3}']),
])
def test_health_of_every_source(spark, tmp_path, source, context, namespace, whole, broken):
    target = tmp_path / "f" / context
    target.mkdir(parents=True)
    for k, doc in enumerate(whole + broken):
        (target / f"{k}.json").write_text(doc)
    got = inventory.read_health(spark, {source: str(tmp_path / "f")}, whole_files=True)
    assert rows(got) == [(namespace, source, False, len(whole) + len(broken), len(broken))]


def test_a_landing_is_held_where_a_document_is_broken(spark, tmp_path, env_dim):
    good = json.dumps([{"name": "s", "statement": "INSERT INTO `b` SELECT * FROM `a`", "status": "RUNNING"}])
    state, docs = str(tmp_path / "state"), str(tmp_path / "docs")
    stats = []
    for cycle, texts in (("1", {"env-a": good, "env-b": good}), ("2", {"env-a": "[]", "env-b": "<html>"}), ("3", {"env-b": "[]"})):
        root = tmp_path / f"landing-{cycle}"
        for env, text in texts.items():
            (root / "flink" / f"env_id={env}").mkdir(parents=True)
            (root / "flink" / f"env_id={env}" / "x.json").write_text(text)
        inv = plan.read_landing(spark, str(root), env_dim)
        assert inv.connectors is None and inv.statements is not None
        none = spark.createDataFrame([], "namespace string, ok boolean")
        s = plan.run_cycle(inv, none, cycle=cycle, event_time=cycle, state_path=state, events_path=docs).first()
        stats.append((s.events_emitted, s.events_removed, s.events_quarantined))
    assert stats == [(2, 0, 0), (0, 1, 1), (0, 1, 0)]


def test_environments_keep_list_order(spark, tmp_path):
    got = inventory.read_environments(spark, land(tmp_path, "e", {"environments": [
        {"env_id": "b", "cluster_id": "c", "kafka_bootstrap": "h"}, {"env_id": "a", "cluster_id": "d", "kafka_bootstrap": "h", "env_ord": 7}]}))
    assert rows(got, "env_id", "env_name", "env_ord") == [("a", "", 7), ("b", "", 0)]


def test_wire_format(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02payload"), 1), (bytearray(b"\x00\xff\xff\xff\xff"), 2),
                                (bytearray(b"\x01\x00\x00\x00\x01x"), 3), (bytearray(b"\x00\x01"), 4), (None, 5)], "value binary, offset long")
    got = {r.offset: (r.schema_id, bytes(r.payload) if r.payload is not None else None) for r in wire.split_wire_format(df).collect()}
    assert got == {1: (258, b"payload"), 2: (4294967295, b""), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_partitioned_write_replaces(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.write_partitioned(spark.createDataFrame([(i, "hot" if i % 3 else "b") for i in range(90)], "n int, status string"), path, "status")
    assert spark.read.parquet(path).groupBy("status").count().orderBy("status").collect() == [("b", 30), ("hot", 60)]
    tables.write_partitioned(spark.createDataFrame([(1, "b")], "n int, status string"), path, "status", replace_all=False)
    assert spark.read.parquet(path).count() == 61
    tables.write_partitioned(spark.createDataFrame([(1, "c")], "n int, status string"), path, "status")
    assert spark.read.parquet(path).count() == 1


def test_a_table_is_replaced_as_a_whole(spark, tmp_path):
    path, name = str(tmp_path / "t"), "tributary_swap_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_or_replace_table(spark.range(3), name, path)
    old = spark.table(name)
    tables.create_or_replace_table(spark.range(5), name, path)
    assert spark.table(name).count() == 5 and len(tables.folders(spark, path)) == 2
    with pytest.raises(Exception, match="USER_RAISED"):
        tables.create_or_replace_table(spark.range(5).selectExpr("if(id = 3, raise_error('no'), id) AS id"), name, path)
    assert spark.table(name).count() == 5
    tables.create_or_replace_table(spark.range(2).selectExpr("id", "'x' AS more"), name, path)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2
    tables.create_or_replace_table(spark.table(name).where("id = 0"), name, path)  # from itself
    assert spark.table(name).count() == 1 and old.schema != spark.table(name).schema
    assert len(tables.folders(spark, path)) == 2
    spark.sql(f"DROP TABLE {name}")
