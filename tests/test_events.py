"""Edges -> jobs, datasets, fingerprints and documents."""

import hashlib
import json
import uuid

from conftest import rows
from pyspark.sql import functions as F

from tributary.functions import identity
from tributary.operators import connect, edges, events, tableflow, topics, usage
from tributary.sources import run_events

EDGE = (
    "source_name string, source_type string, target_name string, target_type string, job_name string,"
    " job_type string, job_namespace string, target_namespace string, kafka_bootstrap string, env_id string,"
    " env_name string, cluster_id string, cluster_name string, cloud string, region string, n int"
)


def edge_table(spark, items):
    df = spark.createDataFrame(items, EDGE)
    seq = F.struct(F.lit(1).alias("scope"), F.lit(0).alias("env_ord"), F.lit(1).alias("builder"),
                   F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name"),
                   F.col("n").alias("pos_in"), F.lit(0).alias("pos_out"),
                   F.col("source_name").alias("source"), F.col("target_name").alias("target"))
    return df.withColumn("edge_seq", seq).drop("n")


def edge(src, tgt, job="j", n=0, st="kafka_topic", tt="kafka_topic", ns="flink://e", tns=None, boot="b:1", env="e", name="", jt="flink_statement"):
    return (src, st, tgt, tt, job, jt, ns, tns, boot, env, name, None, None, None, None, n)


def test_datasets_are_deduplicated_per_side_and_non_datasets_fall_away(spark):
    df = edge_table(spark, [
        edge("a", "o", n=0), edge("b", "o", n=1), edge("a", "o", n=2),
        edge("x", "t", job="p", st="external", jt="kafka_producer"), edge("t", "g", job="g", tt="consumer_group", jt="kafka_consumer_group"),
    ])
    got = events.event_datasets(df)
    assert rows(got, "job_name", "side", "dataset_name") == [
        ("g", "input", "t"), ("j", "input", "a"), ("j", "input", "b"), ("j", "output", "o"), ("p", "output", "t")]
    jobs = events.job_events(got)
    assert rows(jobs, "job_name", "n_inputs", "n_outputs") == [("g", 1, 0), ("j", 2, 1), ("p", 0, 1)]


def test_first_non_empty_topology_and_one_bootstrap(spark):
    df = edge_table(spark, [
        edge("a", "o", n=0, boot=None, env="", name=""), edge("b", "o", n=1, boot="first:1", env="e1", name=""),
        edge("c", "o", n=2, boot="second:1", env="e2", name="two"), edge("a", "b", job="g", boot="", env=None)])
    got = {r.job_name: r for r in events.job_topology(df, "fallback:9").collect()}
    assert (got["j"].env_id, got["j"].env_name, got["j"].kafka_bootstrap) == ("e1", "two", "first:1")
    assert (got["g"].env_id, got["g"].cluster_id, got["g"].kafka_bootstrap) == ("", "", "fallback:9")
    names = {r.dataset_namespace for r in events.event_datasets(df, "fallback:9").collect()}
    assert names == {"kafka://first:1", "kafka://fallback:9"}


def test_jobs_without_namespace_and_names_of_two_types(spark):
    df = edge_table(spark, [
        edge("a", "o", job="lost", ns=None), edge("a", "o", job="two", jt="kafka_connect_source"), edge("b", "o", job="two", jt="kafka_connect_sink"), edge("a", "o")])
    jobs = events.job_events(events.event_datasets(df), "c")
    got = {(r.job_name, r.job_type): r for r in jobs.collect()}
    assert len(got) == 4 and got["lost", "flink_statement"].n_inputs == 1 and got["lost", "flink_statement"].job_namespace is None
    assert len({r.run_id for r in got.values()}) == 4
    # A name with one type keeps the id it always had.
    assert got["j", "flink_statement"].run_id == spark.range(1).select(identity.stable_run_id(F.lit("flink://e"), F.lit("j"), F.lit("c"))).first()[0]


def test_synced_tables_keep_the_first_declared_namespace(spark):
    df = edge_table(spark, [
        edge("a", "tab", n=1, tt="iceberg_table", tns="glue://late"), edge("a", "tab", n=0, tt="iceberg_table", tns="glue://r"),
        edge("a", "bare", job="k", tt="iceberg_table"), edge("in", "o", job="r", st="iceberg_table")])
    got = events.event_datasets(df).where("dataset_type = 'iceberg_table'")
    assert rows(got, "dataset_name", "dataset_namespace") == [
        ("bare", "iceberg://tableflow"), ("in", "flink://e"), ("tab", "glue://r")]


def fingerprints(spark, items):
    return {r.job_name: r.fingerprint for r in events.job_events(events.event_datasets(edge_table(spark, items))).collect()}


def test_fingerprint_sees_datasets_only(spark):
    base = [edge("a", "o", n=0), edge("b", "o", n=1)]
    one = fingerprints(spark, base)["j"]
    assert fingerprints(spark, [edge("b", "o", n=0, env="other"), edge("a", "o", n=1)])["j"] == one
    assert fingerprints(spark, [edge("a", "o")])["j"] != one
    assert fingerprints(spark, [edge("a", "o"), edge("b", "o2")])["j"] != one
    # The same dataset as input or as output is a different thing.
    assert fingerprints(spark, [edge("a", "b")])["j"] != fingerprints(spark, [edge("b", "a")])["j"]
    assert fingerprints(spark, [edge("a", "o", boot="other:1"), edge("b", "o", boot="other:1")])["j"] != one


def test_run_ids_follow_the_uuid_rule(spark):
    df = spark.createDataFrame([(f"ns-{i}", f"job {i} é") for i in range(50)], "a string, b string")
    got = df.select("a", "b", identity.stable_run_id(F.col("a"), F.col("b"), F.lit("c")).alias("r")).collect()
    for r in got:
        digest = hashlib.sha256(f"{r.a}:{r.b}:c".encode()).digest()[:16]
        assert r.r == str(uuid.UUID(bytes=digest, version=4))


def test_unknown_job_types_keep_their_name(spark):
    df = spark.createDataFrame([("tableflow",), ("my_type",)], "t string")
    got = {r.t: tuple(r.f) for r in df.select("t", identity.job_type_facet(F.col("t")).alias("f")).collect()}
    assert got == {"tableflow": ("BATCH", "TABLEFLOW", "TABLE_SYNC"), "my_type": ("STREAMING", "KAFKA", "MY_TYPE")}


def hot_graph(spark, n):
    """One job that owns a third of all edges."""
    return edge_table(spark, [edge(f"t{i:05d}", "sink", job="hot", n=i) for i in range(n)]
                      + [edge(f"t{i:05d}", f"o{i}", job=f"j{i}") for i in range(2 * n)])


def test_large_documents_are_split_without_loss(spark):
    datasets = events.event_datasets(hot_graph(spark, 300))
    jobs = events.job_events(datasets, "c")
    docs = events.run_event_documents(jobs, datasets, cycle="c", event_time="t", producer="p", datasets_per_document=50)
    hot = [r for r in docs.collect() if r.job.name == "hot"]
    assert len(hot) > 4 and len({r.run.runId for r in hot}) == 1
    names = [d.name for r in hot for d in (r.inputs or [])]
    assert sorted(names) == [f"t{i:05d}" for i in range(300)]
    assert sum(len(r.outputs or []) for r in hot) == 1
    assert {r.run.parts for r in hot} == {len(hot)} == {len({r.run.part for r in hot})}
    cold = [r for r in docs.collect() if r.job.name == "j7"]
    assert len(cold) == 1 and cold[0].run.parts == 1


def test_documents_round_trip_with_facets(spark, env_dim, tmp_path):
    conn = spark.createDataFrame(
        [("s", "source", "R", {"topic": "t"}, "env-a", "lkc-a", None), ("k", "sink", "R", {"topics": "t"}, None, None, "own")],
        "name string, type string, status string, config map<string,string>, env_id string, cluster_id string, connect_cluster string")
    flow = spark.createDataFrame([("env-a", "t", "RUNNING")], "env_id string, topic_name string, status string")
    table = edges.lineage_edges([connect.connector_edges(conn), tableflow.tableflow_edges(flow)], env_dim)
    datasets = events.event_datasets(table, "fb:1")
    jobs = events.job_events(datasets, "c1")
    meta = spark.createDataFrame([("lkc-a", "t", 6, 3, False), ("lkc-b", "t", 9, 3, True)],
                                 "cluster_id string, topic string, partitions int, replication_factor int, is_internal boolean")
    fields = spark.createDataFrame([("lkc-a", "t", '[{"name":"value.id","type":"long"}]')], "cluster_id string, topic string, fields_json string")
    faceted = topics.attach_topic_facets(datasets, env_dim, fields, meta)
    docs = events.run_event_documents(jobs, faceted, cycle="c1", event_time="now", producer="p")
    run_events.write_run_events(docs, str(tmp_path / "ev"))
    back = {r["job"]["name"] + "/" + r["job"]["namespace"][:5]: r for r in
            (json.loads(x.j) for x in run_events.read_run_events(spark, str(tmp_path / "ev")).select(F.to_json(F.struct("*")).alias("j")).collect())}
    source = back["s/kafka"]
    out = source["outputs"][0]
    assert "inputs" not in source and out["namespace"] == "kafka://pkc-1.us-east-2.aws.confluent.cloud:9092"
    assert out["facets"]["kafkaTopic"] == {"partitions": 6, "replicationFactor": 3, "isInternal": False}
    assert out["facets"]["schema"]["fields"] == [{"name": "value.id", "type": "long"}]
    assert out["facets"]["confluent"]["region"] == "us-east-2"
    # Outside any environment the map keyed by topic name is used: the last environment wins.
    assert back["k/kafka"]["inputs"][0]["facets"]["kafkaTopic"]["partitions"] == 9
    assert "confluent" not in back["k/kafka"]["inputs"][0]["facets"]
    synced = back["t/table"]["outputs"][0]
    assert synced["namespace"] == "iceberg://tableflow" and "facets" not in synced
    again = run_events.event_datasets_of(run_events.read_run_events(spark, str(tmp_path / "ev")))
    assert rows(again, "job_name", "side", "dataset_name") == rows(datasets, "job_name", "side", "dataset_name")


def test_documents_of_small_jobs_need_one_join(spark, tmp_path):
    """The datasets are read once and joined once with the run ids; no count goes to jobs that fit one document."""
    events.event_datasets(hot_graph(spark, 20)).write.parquet(str(tmp_path / "datasets"))
    datasets = spark.read.parquet(str(tmp_path / "datasets"))
    events.job_events(datasets, "c").write.parquet(str(tmp_path / "jobs"))
    jobs = spark.read.parquet(str(tmp_path / "jobs"))
    docs = events.run_event_documents(jobs, datasets, cycle="c", event_time="t", producer="p")
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and plan.count("Join ") == 1
    assert docs.count() == 41 and {(r.run.part, r.run.parts) for r in docs.collect()} == {(0, 1)}


def test_rows_of_a_large_job_are_joined_by_part(spark):
    datasets = events.event_datasets(hot_graph(spark, 300))
    docs = events.run_event_documents(events.job_events(datasets, "c"), datasets, cycle="c", event_time="t", producer="p", datasets_per_document=50)
    joins = [line for line in docs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert any("(part#" in line for line in joins)


def test_json_text_of_documents_is_parsed_once(spark):
    from tributary.plans.registered import QUERIES
    plan = QUERIES["F18_run_event_json"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("from_json(") == 1
