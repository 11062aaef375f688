"""Registered queries: every operator applied to the whole of the driver's tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixed_values import TOPOLOGY_FACET
from tributary.functions import identity, sqlrefs, text
from tributary.operators import (
    connect, diff, edges, events, graph, ksql, orders, registry, rollups, statements, tableflow,
    topics, usage,
)
from tributary.plans import cycle as cycle_plan
from tributary.schemas import JOB_KEY, TOPOLOGY_COLUMNS
from tributary.session import drop, scratch_path, write_and_reload
from tributary.sources import inventory, run_events, state as state_store, tables, wire
from tributary.sources.adaptors import Landed
from tributary.sources.ledger import Ledger
from tributary.streaming import cycles as stream_cycles
from tributary.streaming import dimension as stream_dimension
from tributary.streaming import keyed as stream_keyed
from tributary.streaming import late as stream_late
from tributary.streaming import orders as stream_orders
from tributary.streaming import usage as stream_usage
from tributary.streaming.dimension import VersionedDimension

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

EVENT_TIME = "2024-02-01T00:00:00Z"
CYCLE = "20240201T000000"
FALLBACK_BOOTSTRAP = "fallback:9092"
EXTRA_PREFIXES = ("app-1", "svc-2")


def query(name: str):
    def register(fn: Callable[[Landed], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Landed(spark, sf_dir))
        return fn
    return register


def _land(df: DataFrame, name: str, *by: str) -> str:
    """Write one text column (and partition columns) as a landing folder."""
    path = scratch_path(df.sparkSession, f"landed-{name}")
    writer = df.write
    (writer.partitionBy(*by) if by else writer).text(path)
    return path


def _stamp(ts="ts"):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# --- Sources and sinks --------------------------------------------------------------------------

def _connect_documents(t: Landed) -> DataFrame:
    document = F.create_map("name", F.struct(
        F.struct(F.upper("type").alias("type"), "config").alias("info"),
        F.struct(F.struct(F.col("status").alias("state")).alias("connector")).alias("status"),
    ))
    return t.connectors().select(
        "env_id", F.regexp_replace("env_id", "^env", "lkc").alias("cluster_id"), "connect_cluster",
        F.to_json(document).alias("value"), F.regexp_extract("name", r"(\d+)$", 1).cast("long").alias("n"),
    )


@query("S1_read_connect_inventory")
def _(t: Landed) -> DataFrame:
    path = _land(_connect_documents(t).drop("n"), "connect", "env_id", "cluster_id", "connect_cluster")
    rows = inventory.read_connect_inventory(t.spark, path)
    return rows.select(
        "id", "name", "status", "type", "env_id", "connect_cluster",
        *[F.try_element_at("config", F.lit(k)).alias(k.replace(".", "_"))
          for k in ("kafka.topic", "topic", "topics", "kafka.topics")],
    )


def _statement_documents(t: Landed) -> DataFrame:
    return t.flink_statements().select("env_id", F.to_json(F.array(F.struct(
        "name", F.col("sql_text").alias("statement"), "status",
    ))).alias("value"), F.regexp_extract("name", r"(\d+)$", 1).cast("long").alias("n"))


@query("S2_read_flink_statements")
def _(t: Landed) -> DataFrame:
    return inventory.read_flink_statements(t.spark, _land(_statement_documents(t).drop("n"), "flink", "env_id"))


def _metric_documents(t: Landed) -> DataFrame:
    row = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("topic").alias("metric.topic"),
        F.col("consumer_group_id").alias("metric.consumer_group_id"),
        F.col("client_id").alias("metric.client_id"), "value",
    )
    page = F.struct(F.array(row).alias("data"), F.struct(F.lit(None).cast("string").alias("page_token")).alias("meta"))
    number = F.regexp_extract("client_id", r"(\d+)$", 1).cast("long")
    return t.metric_rows().select("metric", "cluster_id", F.to_json(page).alias("value"), number.alias("n"))


@query("S3_read_metric_rows")
def _(t: Landed) -> DataFrame:
    rows = inventory.read_metric_rows(t.spark, _land(_metric_documents(t).drop("n"), "metrics", "metric", "cluster_id"))
    return rows.select("cluster_id", "metric", _stamp().alias("ts"), "topic", "consumer_group_id", "client_id", "value")


@query("S4_read_ksql_sources")
def _(t: Landed) -> DataFrame:
    def docs(kind: str, df: DataFrame) -> DataFrame:
        item = F.array(F.struct(F.array(F.struct("name", "topic")).alias("sourceDescriptions")))
        return df.select("ksql_cluster_id", F.lit(kind).alias("kind"), F.to_json(item).alias("value"))

    all_rows = t.view("ksql_descriptions")
    renamed = all_rows.where("custkey % 3 = 0").withColumn("topic", F.concat(F.lit("table-"), "topic"))
    landed = docs("streams", all_rows).union(docs("tables", renamed))
    return inventory.read_ksql_sources(t.spark, _land(landed, "ksql-sources", "ksql_cluster_id", "kind"))


@query("S5_read_ksql_queries")
def _(t: Landed) -> DataFrame:
    flat = t.view("ksql_queries_flat").withColumn("n", F.regexp_extract("query_id", r"(\d+)", 1).cast("bigint"))
    item = F.struct(
        F.struct(F.when(F.col("n") % 50 != 0, F.col("query_id")).otherwise("").alias("queryId")).alias("id"),
        F.when(F.col("n") % 7 != 0, F.col("state")).alias("state"),
        F.lit("SELECT 1").alias("queryString"),
        F.when(F.col("n") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("sink_topic")).alias("sinkKafkaTopics"),
        F.array(F.concat(F.lit("S_"), "sink_topic")).alias("sinks"),
        F.when(F.col("n") % 5 != 0, F.array("source_name", F.lit("x"))).alias("sources"),
    )
    docs = flat.select("ksql_cluster_id", F.to_json(F.array(F.struct(F.array(item).alias("queries")))).alias("value"))
    rows = inventory.read_ksql_queries(t.spark, _land(docs, "ksql-queries", "ksql_cluster_id"))
    return rows.select(
        "query_id", "ksql_cluster_id", "state", F.array_join("sink_topics", ",").alias("sinks"),
        F.array_join("sources", ",").alias("sources"),
    )


@query("S6_read_tableflow_topics")
def _(t: Landed) -> DataFrame:
    n = F.regexp_extract("topic_name", r"(\d+)", 1).cast("bigint")
    item = F.struct(
        F.when(n % 3 == 0, F.col("topic_name")).otherwise("").alias("topic_name"),
        F.when(n % 3 == 1, F.col("topic_name")).alias("display_name"),
        F.when((n % 3 == 2) & (n % 4 != 0), F.col("topic_name")).alias("name"),
        F.when(n % 2 == 0, F.col("status")).otherwise("").alias("phase"),
        F.when(n % 5 != 0, F.lit("PENDING")).alias("status"),
    )
    docs = t.tableflow_topics().select("env_id", F.to_json(F.array(item)).alias("value"))
    return inventory.read_tableflow_topics(t.spark, _land(docs, "tableflow", "env_id"))


@query("S7_read_topic_metadata")
def _(t: Landed) -> DataFrame:
    n = F.regexp_extract("topic", r"(\d+)", 1).cast("bigint")
    item = F.struct(
        F.when(n % 9 != 0, F.col("topic")).alias("topic_name"),
        F.when(n % 10 != 0, F.col("partitions")).alias("partitions_count"),
        "replication_factor", F.when(n % 4 != 0, F.col("is_internal")).alias("is_internal"),
    )
    docs = t.topic_metadata().select("cluster_id", F.to_json(F.struct(F.array(item).alias("data"))).alias("value"))
    return inventory.read_topic_metadata(t.spark, _land(docs, "metadata", "cluster_id"))


@query("S8_read_schema_subjects")
def _(t: Landed) -> DataFrame:
    item = F.struct("subject", "version", F.lower("raw_type").alias("schemaType"), F.col("schema_text").alias("schema"))
    docs = t.view("schema_subjects_raw").select("env_id", F.to_json(item).alias("value"))
    return inventory.read_schema_subjects(t.spark, _land(docs, "subjects", "env_id"))


def _read_deployments(t: Landed) -> DataFrame:
    item = F.struct("env_id", "env_name", "cluster_id", "cluster_name", "kafka_bootstrap", "env_ord")
    docs = t.view("deployments").select(F.to_json(F.struct(F.array(item).alias("environments"))).alias("value"))
    return inventory.read_environments(t.spark, _land(docs, "environments"))


@query("S9_read_environments")
def _(t: Landed) -> DataFrame:
    return _read_deployments(t)


@query("S10_split_wire_format")
def _(t: Landed) -> DataFrame:
    magic = F.when(F.col("orderkey") % 50 == 0, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    schema_id = F.unhex(F.lpad(F.hex(F.col("custkey") * 2), 8, "0"))
    records = t.view("order_records").select(
        F.concat(magic, schema_id, F.encode("itemid", "UTF-8")).alias("value"),
        (F.col("orderkey") % 8).alias("partition"), F.col("orderkey").alias("offset"),
    )
    writers = t.table("part").select(F.col("p_partkey").alias("schema_id"), F.col("p_name").alias("schema_name"))
    rows = wire.with_writer_schema(wire.split_wire_format(records), writers)
    return rows.select("partition", "offset", "schema_id", F.decode("payload", "UTF-8").alias("payload"), "schema_name")


def _orders_with_status(t: Landed) -> DataFrame:
    return t.view("order_records").select("orderid", "status", "itemid", "orderunits")


@query("S11_write_partitioned")
def _(t: Landed) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-status")
    tables.write_partitioned(_orders_with_status(t), path, "status")
    return t.spark.read.parquet(path).select("orderid", F.col("status").cast("string").alias("status"), "itemid", "orderunits")


@query("S12_create_or_replace_table")
def _(t: Landed) -> DataFrame:
    summary = rollups.orders_summary(_orders_with_status(t), EVENT_TIME).drop("computed_at")
    tables.create_or_replace_table(summary, "tributary_order_summary", scratch_path(t.spark, "order-summary"))
    return t.spark.table("tributary_order_summary")


# --- The whole graph, used by many queries ------------------------------------------------------

def _inventory(t: Landed) -> cycle_plan.Inventory:
    return cycle_plan.Inventory(
        env_dim=t.env_dim(), connectors=t.connectors(), statements=t.flink_statements(),
        metrics=t.metric_rows(), ksql_queries=t.ksql_queries(), ksql_sources=t.ksql_sources(),
        tableflow_topics=t.tableflow_topics(), topic_metadata=t.topic_metadata(),
    )


def _edges(t: Landed) -> DataFrame:
    return cycle_plan.build_graph(_inventory(t)).edges


def _event_datasets(t: Landed) -> DataFrame:
    return events.event_datasets(write_and_reload(_edges(t), "edges"), FALLBACK_BOOTSTRAP)


def _jobs(t: Landed) -> DataFrame:
    return events.job_events(write_and_reload(_event_datasets(t), "datasets"), CYCLE)


def _topic_fields(t: Landed) -> DataFrame:
    return registry.flatten_schemas(registry.latest_schema_version(t.schema_subjects()))


def _documents(t: Landed, schemas: DataFrame | None = None) -> DataFrame:
    datasets = write_and_reload(_event_datasets(t), "datasets")
    jobs = events.job_events(datasets, CYCLE)
    rows = topics.attach_topic_facets(
        datasets, t.env_dim(), schemas=schemas, metadata=t.topic_metadata(),
        throughput=usage.topic_throughput(t.metric_rows()),
    )
    rows = write_and_reload(rows, "faceted")
    return events.run_event_documents(jobs, rows, cycle=CYCLE, event_time=EVENT_TIME, producer="tributary")


@query("S13_write_run_events")
def _(t: Landed) -> DataFrame:
    path = scratch_path(t.spark, "run-events")
    run_events.write_run_events(_documents(t), path)
    docs = run_events.read_run_events(t.spark, path)
    return docs.select(
        F.col("eventType").alias("event_type"), F.col("eventTime").alias("event_time"), "producer",
        F.col("job.namespace").alias("job_namespace"), F.col("job.name").alias("job_name"),
        F.col("run.runId").alias("run_id"),
        F.col("job.facets.jobType.integration").alias("integration"),
        F.coalesce(F.size("inputs"), F.lit(0)).cast("bigint").alias("n_inputs"),
        F.coalesce(F.size("outputs"), F.lit(0)).cast("bigint").alias("n_outputs"),
    )


@query("S15_read_run_events")
def _(t: Landed) -> DataFrame:
    path = scratch_path(t.spark, "run-events")
    run_events.write_run_events(_documents(t), path)
    return run_events.event_datasets_of(run_events.read_run_events(t.spark, path))


# --- Broken documents ---------------------------------------------------------------------------

def _numbered_documents(t: Landed) -> dict[str, tuple[DataFrame, Column]]:
    """Documents (context columns, value, n) of each source, and the context that their namespace ends with."""
    def listed(df: DataFrame, *context: str, name: str, fields) -> DataFrame:
        return df.select(*context, F.to_json(F.array(F.struct(*fields))).alias("value"), F.regexp_extract(name, r"(\d+)$", 1).cast("long").alias("n"))

    queries = listed(t.ksql_queries(), "ksql_cluster_id", name="query_id", fields=[F.array(F.struct(
        F.struct(F.col("query_id").alias("queryId")).alias("id"), "state", F.col("sink_topics").alias("sinkKafkaTopics"), "sources")).alias("queries")])
    sources = listed(t.view("ksql_descriptions"), "ksql_cluster_id", name="name", fields=[F.array(F.struct("name", "topic")).alias("sourceDescriptions")])
    return {
        "connect": (_connect_documents(t).drop("cluster_id"), F.coalesce("connect_cluster", "env_id")),
        "flink": (_statement_documents(t), F.col("env_id")),
        "metrics": (_metric_documents(t), F.col("cluster_id")),
        "ksql_queries": (queries, F.col("ksql_cluster_id")),
        "ksql_sources": (sources, F.col("ksql_cluster_id")),
        "tableflow": (listed(t.tableflow_topics(), "env_id", name="topic_name", fields=["topic_name", "status"]), F.col("env_id")),
    }


def _land_documents(docs: DataFrame, path: str, compression: str | None = None) -> None:
    docs = docs.drop("n")
    docs.write.partitionBy(*[c for c in docs.columns if c != "value"]).text(path, compression=compression)


def _landing(t: Landed) -> str:
    """A landing folder of all sources. Documents whose number 11 divides have gone since the last cycle. In contexts
    that end in 1 or 3, every thirteenth is broken: cut off, an error body, a page of HTML, or nothing."""
    root = scratch_path(t.spark, "landing")
    for source, (docs, context) in _numbered_documents(t).items():
        n = F.col("n")
        broken = (n % 13 == 5) & F.substring(context, -1, 1).isin("1", "3")
        wreck = (
            F.when(n % 4 == 0, F.expr("substring(value, 1, length(value) - 3)")).when(n % 4 == 1, F.lit('{"error_code":401,"message":"no"}'))
            .when(n % 4 == 2, F.lit("<html>503</html>")).otherwise(F.lit("null")))
        # What the queries read from stays whole: a missing stream name would change documents of other jobs.
        gone = F.lit(False) if source == "ksql_sources" else n % 11 == 0
        _land_documents(docs.where(~gone).withColumn("value", F.when(broken, wreck).otherwise(F.col("value"))), f"{root}/{source}")
    return root


@query("S1_payload_health")
def _(t: Landed) -> DataFrame:
    """Documents and broken documents of every namespace and source; also S2 to S6."""
    root = _landing(t)
    return inventory.read_health(t.spark, {s: f"{root}/{s}" for s in ("connect", "flink", "metrics", "ksql_queries", "ksql_sources", "tableflow")})


@query("J7_broken_documents")
def _(t: Landed) -> DataFrame:
    """A cycle over a landing with broken documents, against the jobs of the whole inventory: jobs that cannot be
    seen are held where a document of their namespace is broken, else removed."""
    known = events.job_events(_event_datasets(t), CYCLE).select(*JOB_KEY, "fingerprint", F.lit(EVENT_TIME).alias("last_seen_at"))
    inv = cycle_plan.read_landing(t.spark, _landing(t), t.env_dim())
    # The names of streams are not what is looked at here.
    inv.ksql_sources = t.ksql_sources()
    seen = events.event_datasets(write_and_reload(cycle_plan.build_graph(inv).edges, "edges"), FALLBACK_BOOTSTRAP)
    jobs = events.job_events(write_and_reload(seen, "datasets"), CYCLE)
    known = write_and_reload(known, "known")
    health = diff.expected_health(diff.combined_health(inv.payload_health), known.select(F.col("job_namespace").alias("namespace")))
    return diff.diff_cycle(jobs, known, diff.failed_namespaces(health)).select(*JOB_KEY, "action")


def _as_jobs(history: DataFrame) -> DataFrame:
    return history.select(
        F.col("namespace").alias("job_namespace"), F.col("name").alias("job_name"),
        F.lit("job").alias("job_type"), F.sha2("fp", 256).alias("fingerprint"),
    )


def _last_seen_state(t: Landed) -> DataFrame:
    """Every job ever seen, with its latest fingerprint."""
    last = t.job_history().groupBy("namespace", "name").agg(
        F.max_by("fp", "cycle").alias("fp"), F.max("cycle").cast("string").alias("last_seen_at"),
    )
    return _as_jobs(last).join(last.select(
        F.col("namespace").alias("job_namespace"), F.col("name").alias("job_name"), "last_seen_at",
    ), ["job_namespace", "job_name"])


@query("S14_write_state")
def _(t: Landed) -> DataFrame:
    path = scratch_path(t.spark, "state")
    state_store.write_state(_last_seen_state(t), path, "0001")
    return state_store.read_state(t.spark, path)


@query("S16_read_state")
def _(t: Landed) -> DataFrame:
    path = scratch_path(t.spark, "state")
    last = _last_seen_state(t)
    state_store.write_state(last, path, "0001")
    blank = F.when(F.col("job_namespace") == "ns-3", "").otherwise(F.col("fingerprint"))
    state_store.write_state(last.withColumn("fingerprint", blank), path, "0002")
    # Written but never published, as after a crash: must not be seen.
    last.limit(0).write.parquet(os.path.join(path, "v=0003"))
    return state_store.read_state(t.spark, path)


# --- Projections, filters, predicates -----------------------------------------------------------

@query("P1_connector_topics")
def _(t: Landed) -> DataFrame:
    return connect.connector_topics(t.connectors()).select("name", "type", "pos", "topic")


_DRAFT = ("source_name", "source_type", "target_name", "target_type", "job_name", "job_type", "job_namespace")


@query("P2_connector_edges")
def _(t: Landed) -> DataFrame:
    return connect.connector_edges(t.connectors()).select(*_DRAFT)


@query("P3_active_statements")
def _(t: Landed) -> DataFrame:
    return statements.active_statements(t.flink_statements()).select("name", "status")


@query("P4_flink_edges")
def _(t: Landed) -> DataFrame:
    return statements.flink_edges(t.flink_statements()).select(*_DRAFT, "pos_in", "pos_out")


@query("P5_ksql_active")
def _(t: Landed) -> DataFrame:
    rows = ksql.ksql_edges(t.ksql_queries(), t.ksql_sources())
    return rows.select(*_DRAFT)


@query("P6_tableflow_active")
def _(t: Landed) -> DataFrame:
    return tableflow.tableflow_active(t.tableflow_topics()).select("env_id", "topic_name", "status")


@query("P7_external_groups")
def _(t: Landed) -> DataFrame:
    return usage.external_groups(t.metric_rows(), EXTRA_PREFIXES).select("event_id", "consumer_group_id")


@query("P8_external_producers")
def _(t: Landed) -> DataFrame:
    return usage.external_producers(t.metric_rows(), EXTRA_PREFIXES).select("event_id", "client_id")


@query("P9_valid_metric_rows")
def _(t: Landed) -> DataFrame:
    rows = t.metric_rows()
    return (
        usage.valid_throughput(rows).select("event_id", F.lit("throughput").alias("use"))
        .union(usage.valid_bindings(rows, "client_id").select("event_id", F.lit("producer")))
        .union(usage.valid_bindings(rows, "consumer_group_id").select("event_id", F.lit("group")))
    )


@query("P10_lookback")
def _(t: Landed) -> DataFrame:
    as_of = F.lit("2024-01-20 12:34:56").cast("timestamp")
    return usage.lookback(t.metric_rows(), as_of, 14400).select("event_id", _stamp().alias("ts"))


@query("P11_cluster_filter")
def _(t: Landed) -> DataFrame:
    return usage.cluster_filter(t.metric_rows(), "lkc-2").select("event_id", "cluster_id", "metric", "topic")


@query("P12_dataset_endpoints")
def _(t: Landed) -> DataFrame:
    return edges.dataset_endpoints(_edges(t)).select(*JOB_KEY, "side", "dataset_type", "dataset_name")


@query("P13_select_by_prefix")
def _(t: Landed) -> DataFrame:
    return edges.select_by_prefix(t.flink_statements(), "stmt-1").select("name", "env_id")


@query("P14_enrich_orders")
def _(t: Landed) -> DataFrame:
    return orders.enrich_orders(t.orders())


@query("P15_high_value_alerts")
def _(t: Landed) -> DataFrame:
    return orders.high_value_alerts(orders.enrich_orders(t.orders()))


@query("P16_medium_risk_orders")
def _(t: Landed) -> DataFrame:
    rows = orders.medium_risk_orders(orders.enrich_orders(t.orders()))
    return rows.withColumn("key", F.hex("key"))


@query("P17_identity_stage")
def _(t: Landed) -> DataFrame:
    kept = orders.identity_stage(t.orders(), F.col("orderunits") >= 0)
    return kept.select("ordertime", "orderid", "itemid", "orderunits", "address.*")


@query("P18_job_type_facet")
def _(t: Landed) -> DataFrame:
    return _jobs(t).select("job_namespace", "job_name", "job_type", identity.job_type_facet(F.col("job_type")).alias("f")).select(
        "job_namespace", "job_name", "f.processingType", "f.integration", "f.jobType")


@query("P19_namespaces")
def _(t: Landed) -> DataFrame:
    rows = t.tableflow_topics()
    parts = []
    for region, database in ((None, None), ("us-east-2", "lake")):
        namespace, name = identity.synced_table(F.col("topic_name"), region, database)
        parts.append(rows.select("topic_name", namespace.alias("namespace"), name.alias("table_name")))
    return parts[0].union(parts[1])


@query("P20_usage_edges")
def _(t: Landed) -> DataFrame:
    rows = t.metric_rows()
    drafts = [
        usage.producer_edges(usage.producers(rows)), usage.group_edges(usage.consumer_groups(rows)),
        tableflow.tableflow_edges(t.tableflow_topics()),
    ]
    return drafts[0].union(drafts[1]).union(drafts[2]).select(*_DRAFT, "target_namespace")


@query("P21_edge_listing")
def _(t: Landed) -> DataFrame:
    return edges.edge_listing(_edges(t))


@query("P22_facet_filter")
def _(t: Landed) -> DataFrame:
    datasets = write_and_reload(_event_datasets(t), "datasets")
    jobs = edges.facet_filter(events.job_events(datasets, CYCLE), env_id="env-1").select(
        "job_namespace", "job_name", F.lit("job").alias("what"))
    data = edges.facet_filter(datasets, region="zone-2").select(
        "dataset_namespace", "dataset_name", F.lit("dataset")).distinct()
    return jobs.union(data)


# --- Joins --------------------------------------------------------------------------------------

@query("J1_cross_io")
def _(t: Landed) -> DataFrame:
    rows = statements.cross_io(statements.statement_refs(t.flink_statements()))
    return rows.select("name", "pos_in", "input", "pos_out", "output")


@query("J2_resolve_ksql_topics")
def _(t: Landed) -> DataFrame:
    return ksql.resolve_ksql_topics(t.ksql_queries(), t.ksql_sources()).select(
        "query_id", "ksql_cluster_id", "source", "source_topic")


@query("J3_drop_self_reference")
def _(t: Landed) -> DataFrame:
    refs = statements.statement_refs(t.flink_statements()).select("name", F.array_join("inputs", ",").alias("inputs"))
    rows = ksql.drop_self_reference(ksql.resolve_ksql_topics(t.ksql_queries(), t.ksql_sources()))
    return refs.union(rows.select("query_id", "source_topic"))


def _topics_with_schema(t: Landed) -> DataFrame:
    latest = registry.latest_schema_version(t.schema_subjects())
    return registry.topics_with_schema(edges.graph_topics(_edges(t)), latest)


@query("J4_topics_with_schema")
def _(t: Landed) -> DataFrame:
    return _topics_with_schema(t).select("env_id", "topic", "key_subject", "key_schema_type", "value_subject", "value_schema_type")


@query("J5_attach_topic_facets")
def _(t: Landed) -> DataFrame:
    schemas = _topics_with_schema(t).select(
        "cluster_id", "topic", F.concat_ws(",", "key_subject", "value_subject").alias("subjects"))
    rows = topics.attach_topic_facets(
        _event_datasets(t), t.env_dim(), schemas, t.topic_metadata(), usage.topic_throughput(t.metric_rows()))
    return rows.select(
        *JOB_KEY, "side", "dataset_namespace", "dataset_name", "schema.subjects", "kafka_topic.partitions",
        "kafka_topic.is_internal", "kafka_throughput.bytes_in", "kafka_throughput.records_out")


@query("J6_stamp_topology")
def _(t: Landed) -> DataFrame:
    return _edges(t).select("job_namespace", "job_name", "source_name", "target_name", "kafka_bootstrap", *TOPOLOGY_COLUMNS)


def _latest_cycle(t: Landed) -> int:
    return t.job_history().agg(F.max("cycle")).first()[0]


def _cycle_inputs(t: Landed) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(jobs now, known state, failed namespaces) of the latest cycle; known is every job seen before."""
    history, cycle = t.job_history(), _latest_cycle(t)
    now = _as_jobs(history.where(F.col("cycle") == cycle))
    before = history.where(F.col("cycle") < cycle).groupBy("namespace", "name").agg(
        F.max_by("fp", "cycle").alias("fp"), F.max("cycle").cast("string").alias("last_seen_at"))
    known = before.select(
        F.col("namespace").alias("job_namespace"), F.col("name").alias("job_name"), F.lit("job").alias("job_type"),
        F.sha2("fp", 256).alias("fingerprint"), "last_seen_at")
    health = t.source_health().where(F.col("cycle") == cycle)
    failed = diff.failed_namespaces(diff.expected_health(health, known.select(F.col("job_namespace").alias("namespace"))))
    return now, known, failed


@query("J7_diff_cycle")
def _(t: Landed) -> DataFrame:
    return diff.diff_cycle(*_cycle_inputs(t)).select("job_namespace", "job_name", "action")


@query("J8_quarantine_filter")
def _(t: Landed) -> DataFrame:
    now, known, failed = _cycle_inputs(t)
    gone = diff.removed_keys(known, now)
    held = diff.quarantine_filter(gone, failed, keep=True).select("job_namespace", "job_name", F.lit("held").alias("fate"))
    return held.union(diff.quarantine_filter(gone, failed, keep=False).select("job_namespace", "job_name", F.lit("removed")))


def _two_env_lists(t: Landed) -> tuple[DataFrame, DataFrame]:
    """The deployments, and a later list: some gone, some new, some with another bootstrap."""
    old = t.view("deployments")
    key = F.col("env_ord")
    new = old.where(key % 7 != 0).withColumns({
        "env_id": F.when(key % 5 == 0, F.concat("env_id", F.lit("-b"))).otherwise(F.col("env_id")),
        "kafka_bootstrap": F.when(key % 3 == 0, F.lit("moved:9092")).otherwise(F.col("kafka_bootstrap")),
    })
    return old, new


@query("J9_diff_environments")
def _(t: Landed) -> DataFrame:
    columns = ["env_id", "env_name", "cluster_id", "cluster_name", "kafka_bootstrap"]
    old, new = (diff.environment_signature(e, columns) for e in _two_env_lists(t))
    return diff.diff_environments(old, new)


@query("J10_reconcile")
def _(t: Landed) -> DataFrame:
    state = (
        t.table("part").selectExpr("'topic' AS kind", "'topic-' || p_partkey AS key")
        .union(t.view("flink_statements").selectExpr("'statement'", "name"))
        .union(t.view("connectors_json").selectExpr("'connector'", "name"))
    )
    actual = (
        t.view("tableflow_topics").selectExpr("'topic' AS kind", "topic_name AS key").where("key NOT LIKE '%3'")
        .union(t.view("flink_statements").where("status = 'RUNNING'").selectExpr("'statement'", "name"))
    )
    return diff.reconcile(state, actual)


@query("J11_job_dependencies")
def _(t: Landed) -> DataFrame:
    return graph.job_dependencies(write_and_reload(_event_datasets(t), "datasets"))


@query("J12_prefix_anti_join")
def _(t: Landed) -> DataFrame:
    prefixes = t.table("supplier").selectExpr("'svc-' || (s_suppkey * 3) AS prefix").union(
        t.table("supplier").selectExpr("'connector-' || s_nationkey"))
    return usage.prefix_anti_join(t.metric_rows(), prefixes, "client_id").select("event_id", "client_id")


@query("J13_stamp_event_facets")
def _(t: Landed) -> DataFrame:
    rows = _event_datasets(t)
    rows = rows.withColumn("facets", events.dataset_facets(rows))
    return rows.select(*JOB_KEY, "side", "dataset_namespace", "dataset_name", f"facets.{TOPOLOGY_FACET}.*")


# --- Aggregations -------------------------------------------------------------------------------

@query("A1_consumer_groups")
def _(t: Landed) -> DataFrame:
    return usage.consumer_groups(t.metric_rows(), EXTRA_PREFIXES)


@query("A2_producers")
def _(t: Landed) -> DataFrame:
    return usage.producers(t.metric_rows(), EXTRA_PREFIXES)


@query("A3_topic_throughput")
def _(t: Landed) -> DataFrame:
    return usage.topic_throughput(t.metric_rows())


@query("A4_job_events")
def _(t: Landed) -> DataFrame:
    return _jobs(t).select(*JOB_KEY, "event_type", "run_id", "n_inputs", "n_outputs")


@query("A5_topology_of_job")
def _(t: Landed) -> DataFrame:
    return events.job_topology(_edges(t), FALLBACK_BOOTSTRAP).select(*JOB_KEY, *TOPOLOGY_COLUMNS)


@query("A6_bootstrap_of_job")
def _(t: Landed) -> DataFrame:
    return events.job_topology(_edges(t), FALLBACK_BOOTSTRAP).select(*JOB_KEY, "kafka_bootstrap")


@query("A7_graph_summary")
def _(t: Landed) -> DataFrame:
    built = cycle_plan.build_graph(_inventory(t))
    built.edges = write_and_reload(built.edges, "edges")
    built.topic_schemas = _topics_with_schema(t)
    return cycle_plan.summary(built)


@query("A8_cycle_stats")
def _(t: Landed) -> DataFrame:
    history = diff.diff_history(t.job_history(), t.source_health())
    return diff.cycle_stats(history, by=("cycle",))


@query("A9_orders_summary")
def _(t: Landed) -> DataFrame:
    return rollups.orders_summary(_orders_with_status(t), "2024-02-01 00:00:00").withColumn(
        "computed_at", _stamp("computed_at"))


def _adjacency(t: Landed) -> DataFrame:
    return graph.lineage_adjacency(_event_datasets(t))


def _shown(node: Column) -> Column:
    return F.translate(node, "\x1f", "|")


def _readable(column: str):
    return _shown(F.col(column)).alias(column)


@query("A10_component_size")
def _(t: Landed) -> DataFrame:
    return graph.component_size(graph.components(_adjacency(t))).withColumn("component", _readable("component"))


@query("A11_topology_rollup")
def _(t: Landed) -> DataFrame:
    return rollups.topology_rollup(write_and_reload(_event_datasets(t), "datasets"))


@query("A12_metric_minute_rollup")
def _(t: Landed) -> DataFrame:
    rows = usage.metric_minute_rollup(t.metric_rows(), "cluster_id", "metric")
    return rows.select(_stamp("minute").alias("minute"), "cluster_id", "metric", F.round("value", 2).alias("value"))


@query("A13_known_keys")
def _(t: Landed) -> DataFrame:
    return diff.known_keys(_edges(t))


# --- Windows ------------------------------------------------------------------------------------

@query("W1_first_seen_dataset")
def _(t: Landed) -> DataFrame:
    return events.first_seen_dataset(_edges(t)).select(
        *JOB_KEY, "side", "dataset_type", "dataset_name", "declared_namespace",
        F.col("first_seq.source").alias("first_source"), F.col("first_seq.target").alias("first_target"))


@query("W2_last_env_wins")
def _(t: Landed) -> DataFrame:
    return topics.last_env_wins(usage.topic_throughput(t.metric_rows()), t.env_dim())


@query("W3_diff_history")
def _(t: Landed) -> DataFrame:
    return diff.diff_history(t.job_history(), t.source_health())


@query("W4_latest_schema_version")
def _(t: Landed) -> DataFrame:
    return registry.latest_schema_version(t.schema_subjects())


@query("W5_last_healthy_cycle")
def _(t: Landed) -> DataFrame:
    return diff.failed_spells(t.source_health())


# --- Sorts, limits, top-k -----------------------------------------------------------------------

@query("O1_sorted_bindings")
def _(t: Landed) -> DataFrame:
    rows = t.metric_rows()
    both = usage.consumer_groups(rows).selectExpr("'group' AS kind", "cluster_id", "consumer_group_id AS id", "topic").union(
        usage.producers(rows).selectExpr("'producer'", "cluster_id", "client_id", "topic"))
    return both.orderBy("kind", "cluster_id", "id", "topic")


@query("O2_sorted_throughput")
def _(t: Landed) -> DataFrame:
    return usage.topic_throughput(t.metric_rows()).orderBy("topic", "cluster_id")


@query("O3_sorted_dataset_keys")
def _(t: Landed) -> DataFrame:
    return _documents(t).select(
        F.col("job.namespace").alias("job_namespace"), F.col("job.name").alias("job_name"),
        F.array_join(F.transform("inputs", lambda d: d["name"]), ",").alias("inputs"),
        F.array_join(F.transform("outputs", lambda d: d["name"]), ",").alias("outputs"))


@query("O4_summary_by_status")
def _(t: Landed) -> DataFrame:
    return rollups.orders_summary(_orders_with_status(t), EVENT_TIME).drop("computed_at")


@query("O5_busiest_topics")
def _(t: Landed) -> DataFrame:
    return usage.busiest_topics(usage.topic_throughput(t.metric_rows()), 20)


# --- Set operations -----------------------------------------------------------------------------

@query("U1_lineage_edges")
def _(t: Landed) -> DataFrame:
    return _edges(t).select(
        *_DRAFT, "target_namespace", "kafka_bootstrap", *TOPOLOGY_COLUMNS,
        "edge_seq.scope", "edge_seq.env_ord", "edge_seq.builder", "edge_seq.pos_in", "edge_seq.pos_out")


@query("U2_removed_keys")
def _(t: Landed) -> DataFrame:
    now, known, _failed = _cycle_inputs(t)
    return diff.removed_keys(known, now).select("job_namespace", "job_name")


@query("U3_failed_namespaces")
def _(t: Landed) -> DataFrame:
    """Namespaces seen in orders of any year, with the health of one year; no row means failed."""
    history = t.source_health()
    year = history.where(F.col("cycle") == _latest_cycle(t)).where("namespace <> 'ns-5'")
    return diff.failed_namespaces(diff.expected_health(year, history))


@query("U4_graph_topics")
def _(t: Landed) -> DataFrame:
    return edges.graph_topics(_edges(t))


@query("U5_environment_sets")
def _(t: Landed) -> DataFrame:
    return diff.environment_sets(*_two_env_lists(t))


# --- Scalar functions ---------------------------------------------------------------------------

@query("F1_strip_sql_comments")
def _(t: Landed) -> DataFrame:
    return t.flink_statements().select("name", sqlrefs.strip_sql_comments(F.col("sql_text")).alias("sql_text"))


@query("F2_extract_outputs")
def _(t: Landed) -> DataFrame:
    stripped = sqlrefs.strip_sql_comments(F.col("sql_text"))
    return t.flink_statements().select("name", F.array_join(sqlrefs.extract_outputs(stripped), ",").alias("outputs"))


@query("F3_extract_inputs")
def _(t: Landed) -> DataFrame:
    stripped = sqlrefs.strip_sql_comments(F.col("sql_text"))
    return t.flink_statements().select("name", F.array_join(sqlrefs.extract_inputs(stripped), ",").alias("inputs"))


@query("F4_drop_keywords")
def _(t: Landed) -> DataFrame:
    words = F.split("sql_text", r"\s+")
    return t.flink_statements().select("name", F.array_join(sqlrefs.drop_keywords(words), " ").alias("words"))


@query("F5_parse_cloud_region")
def _(t: Landed) -> DataFrame:
    cloud, region = identity.cloud_region(F.col("kafka_bootstrap"))
    return t.view("deployments").select("env_id", cloud.alias("cloud"), region.alias("region"))


@query("F6_stable_run_id")
def _(t: Landed) -> DataFrame:
    run_id = identity.stable_run_id(F.col("env_id"), F.col("name"), F.lit(CYCLE))
    return t.flink_statements().select("name", run_id.alias("run_id"))


@query("F7_fingerprint")
def _(t: Landed) -> DataFrame:
    return _jobs(t).select(*JOB_KEY, "fingerprint")


@query("F8_iceberg_table_name")
def _(t: Landed) -> DataFrame:
    return t.tableflow_topics().select("topic_name", identity.table_name_of_topic(F.col("topic_name")).alias("table_name"))


def _fields(t: Landed, schema_type: str) -> DataFrame:
    return registry.flatten_schemas(t.schema_subjects().where(F.col("schema_type") == schema_type)).select(
        "env_id", "subject", "version", F.array_join("names", ".").alias("field"), "depth", "pos", "type", "description")


@query("F9_render_avro_type")
def _(t: Landed) -> DataFrame:
    return _fields(t, "AVRO").select("subject", "version", "field", "type")


@query("F10_avro_fields")
def _(t: Landed) -> DataFrame:
    return _fields(t, "AVRO").select("subject", "version", "field", "depth", "pos", "description")


@query("F11_json_schema_fields")
def _(t: Landed) -> DataFrame:
    return _fields(t, "JSON").select("subject", "version", "field", "depth", "pos", "type")


@query("F12_protobuf_field")
def _(t: Landed) -> DataFrame:
    return _fields(t, "PROTOBUF").select("subject", "version", "field", "type", "description")


@query("F13_schema_facet_fields")
def _(t: Landed) -> DataFrame:
    return registry.schema_facet_fields(_topic_fields(t)).select("env_id", "topic", "part", "depth", "name", "type", "description")


@query("F14_cycle_key")
def _(t: Landed) -> DataFrame:
    return t.metric_rows().select("event_id", text.cycle_key(F.col("ts")).alias("cycle_key"))


@query("F15_floor_minute")
def _(t: Landed) -> DataFrame:
    return t.metric_rows().select("event_id", _stamp(text.floor_minute(F.col("ts"))).alias("minute"))


@query("F16_abort_run_id")
def _(t: Landed) -> DataFrame:
    removed = diff.diff_history(t.job_history(), t.source_health()).where(F.col("action") == diff.ABORT)
    run_id = identity.abort_run_id(F.col("namespace"), F.col("name"), F.col("cycle").cast("string"))
    return removed.select("cycle", "namespace", "name", run_id.alias("run_id"))


@query("F17_job_key")
def _(t: Landed) -> DataFrame:
    return diff.known_keys(_edges(t)).select(
        identity.job_key_text(F.col("job_namespace"), F.col("job_name")).alias("job_key"), "job_type")


@query("F18_run_event_json")
def _(t: Landed) -> DataFrame:
    """Fields of the documents' JSON text, which is parsed once for all of them."""
    doc = _documents(t).select(F.to_json(F.struct("*")).alias("doc"))
    facets = "struct<kafkaTopic: struct<partitions: int>, kafkaThroughput: struct<bytesIn: bigint>>"
    entries = f"array<struct<namespace: string, name: string, facets: {facets}>>"
    shape = f"struct<job: struct<namespace: string, name: string>, run: struct<runId: string>, inputs: {entries}, outputs: {entries}>"
    first = {side: F.get(f"d.{side}", F.lit(0)) for side in ("inputs", "outputs")}
    return doc.select(F.from_json("doc", shape).alias("d")).select(
        F.col("d.job.namespace").alias("job_namespace"), F.col("d.job.name").alias("job_name"),
        F.col("d.run.runId").alias("run_id"), first["inputs"]["name"].alias("first_input"),
        first["inputs"]["facets"]["kafkaTopic"]["partitions"].alias("partitions"),
        first["outputs"]["namespace"].alias("first_output_namespace"),
        first["outputs"]["facets"]["kafkaThroughput"]["bytesIn"].alias("bytes_in"))


@query("F18_schema_facet")
def _(t: Landed) -> DataFrame:
    """Documents with the schema facet, written and read back: top-level fields of every dataset, as they stand in it."""
    facets = registry.schema_facets(_topic_fields(t)).join(t.env_dim().select("env_id", "cluster_id"), "env_id")
    path = scratch_path(t.spark, "run-events")
    run_events.write_run_events(_documents(t, facets.select("cluster_id", "topic", "fields_json")), path)
    entry = "array<struct<namespace: string, name: string, facets: struct<schema: struct<fields: array<struct<name: string, type: string>>>>>>"
    doc = f"struct<job: struct<namespace: string, name: string>, inputs: {entry}, outputs: {entry}>"
    docs = t.spark.read.text(path).select(F.from_json("value", doc).alias("d"))
    sides = [docs.select("d.job.*", F.lit(side).alias("side"), F.explode(text.computed(F.col(f"d.{column}"))).alias("e")) for side, column in (("input", "inputs"), ("output", "outputs"))]
    shown = F.array_join(F.transform("e.facets.schema.fields", lambda f: F.concat(f["name"], F.lit(":"), f["type"])), ",")
    return sides[0].union(sides[1]).select(
        F.col("namespace").alias("job_namespace"), F.col("name").alias("job_name"), "side",
        F.col("e.namespace").alias("dataset_namespace"), F.col("e.name").alias("dataset_name"), shown.alias("fields"))


# --- Graph --------------------------------------------------------------------------------------

@query("G1_lineage_adjacency")
def _(t: Landed) -> DataFrame:
    return _adjacency(t).select(_readable("src"), _readable("dst"), "kind")


@query("G2_reach")
def _(t: Landed) -> DataFrame:
    adj = write_and_reload(_adjacency(t), "adjacency")
    seeds = graph.endpoints(adj).where(F.col("role") == "source")
    return graph.reach(adj, seeds, "downstream").select(_readable("node"), "depth")


@query("G2_reach_by_seed")
def _(t: Landed) -> DataFrame:
    """What every connector feeds and is fed by, to a depth of three steps."""
    edges_ = write_and_reload(_edges(t), "edges")
    datasets = write_and_reload(events.event_datasets(edges_, FALLBACK_BOOTSTRAP), "datasets")
    drop(edges_)
    adj = write_and_reload(graph.lineage_adjacency(datasets), "adjacency")
    drop(datasets)
    ends = adj.select(F.explode(F.array("src", "dst")).alias("node"))
    seeds = write_and_reload(ends.where(F.col("node").startswith("job\x1fkafka-connect://")).distinct(), "connectors")
    numbers = graph.numbered(adj, seeds)
    drop(adj)
    parts = [
        graph.reach_by_seed(adj, seeds, direction, 3, _shown, numbers).select(F.lit(direction).alias("direction"), "seed", "node", "depth")
        for direction in ("downstream", "upstream")]
    drop(numbers[1])
    return parts[0].union(parts[1])


@query("G3_components")
def _(t: Landed) -> DataFrame:
    return graph.components(_adjacency(t)).select(_readable("node"), _readable("component"))


@query("G4_endpoints")
def _(t: Landed) -> DataFrame:
    return graph.endpoints(_adjacency(t)).select(_readable("node"), "role")


# --- Streaming ----------------------------------------------------------------------------------

def _stream_table(t: Landed, name: str, view: str) -> DataFrame:
    """The table file as a file stream, in the shape of a view."""
    from tributary.sources.adaptors import VIEWS

    schema = t.table(name).schema
    raw = t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.sf_dir)
    return raw.selectExpr(*[f"{e} AS {c}" for c, e in VIEWS[view][2].items()])


def _stream_metrics(t: Landed) -> DataFrame:
    return _stream_table(t, "events", "metric_rows").withColumn("ts", F.col("ts").cast("timestamp"))


def _run_to_files(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-checkpoint")
    started = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _announce(t: Landed, landed: DataFrame) -> str:
    """Drop one mark per cycle found in the landed rows."""
    path = scratch_path(t.spark, "marks")
    marks = landed.select(F.col("cycle").cast("string").alias("cycle")).distinct()
    marks.withColumn("event_time", F.concat("cycle", F.lit("-12-31T00:00:00Z"))).write.json(path)
    return path


def _follow_diff(t: Landed, undelivered=None, stop_after: str | None = None) -> tuple[str, str, str]:
    """Stream all cycles of the job history; optionally stop once and start a second query."""
    history = scratch_path(t.spark, "history")
    health = scratch_path(t.spark, "health")
    t.job_history().write.partitionBy("cycle").parquet(history)
    t.source_health().write.partitionBy("cycle").parquet(health)
    jobs, ok = t.spark.read.parquet(history), t.spark.read.parquet(health)
    state, actions = scratch_path(t.spark, "state"), scratch_path(t.spark, "actions")
    step = stream_cycles.diff_step(
        t.spark, lambda c: _as_jobs(jobs.where(F.col("cycle") == int(c))),
        lambda c: ok.where(F.col("cycle") == int(c)),
        state, actions, force=False, undelivered=undelivered,
    )
    checkpoint = scratch_path(t.spark, "checkpoint")
    if stop_after is not None:
        early = _announce(t, jobs.where(F.col("cycle") <= int(stop_after)))
        stream_cycles.follow_cycles(t.spark, early, scratch_path(t.spark, "checkpoint"), state, step).awaitTermination()
    stream_cycles.follow_cycles(t.spark, _announce(t, jobs), checkpoint, state, step).awaitTermination()
    return state, actions, history


def _actions(t: Landed, path: str) -> DataFrame:
    return t.spark.read.parquet(path).select(
        F.col("cycle").cast("int").alias("cycle"), F.col("job_namespace").alias("namespace"),
        F.col("job_name").alias("name"), "action")


@query("T1_run_cycles")
def _(t: Landed) -> DataFrame:
    """The whole cycle plan once per year: each job of the history is a statement landed that year."""
    landed = scratch_path(t.spark, "landed-cycles")
    t.job_cycles().select(
        "cycle", "name",
        F.concat(F.lit("env-"), F.substring_index("namespace", "-", -1)).alias("env_id"),
        F.lit("RUNNING").alias("status"),
        F.concat(F.lit("INSERT INTO `"), "output_topic", F.lit("` SELECT * FROM `"), "input_topic", F.lit("`")).alias("sql_text"),
    ).write.partitionBy("cycle").parquet(landed)
    rows = t.spark.read.parquet(landed)
    health = write_and_reload(t.source_health(), "health").select(
        "cycle", F.concat(F.lit("flink://env-"), F.substring_index("namespace", "-", -1)).alias("namespace"), "ok")
    state, docs, stats = (scratch_path(t.spark, n) for n in ("state", "run-events", "stats"))

    def step(cycle: str, event_time: str) -> None:
        inv = cycle_plan.Inventory(env_dim=t.env_dim(), statements=rows.where(F.col("cycle") == int(cycle)))
        cycle_plan.run_cycle(
            inv, health.where(F.col("cycle") == int(cycle)), cycle=cycle, event_time=event_time,
            state_path=state, events_path=docs, force=False,
        ).write.mode("overwrite").parquet(f"{stats}/part={cycle}")

    marks = _announce(t, rows)
    stream_cycles.follow_cycles(t.spark, marks, scratch_path(t.spark, "checkpoint"), state, step).awaitTermination()
    return t.spark.read.parquet(stats).drop("part")


# Cycle -> sources whose mark comes with the marks of the next cycle, and sources that are never landed.
_LATE, _NEVER = {"2": ["tableflow"]}, {"3": ["connect"]}
_WINDOW_MINUTES = 14_400


@query("T1_cycles_of_all_sources")
def _(t: Landed) -> DataFrame:
    """Four cycles of seven sources through the whole cycle plan. In each another fifth of the documents is not there. One
    source is late in the second cycle, which waits for it; one never comes in the third, which runs without it when
    the fourth is complete, and holds its jobs."""
    documents = {s: docs for s, (docs, _) in _numbered_documents(t).items()}
    item = F.struct(F.array(F.struct(F.col("topic").alias("topic_name"), F.col("partitions").alias("partitions_count"), "replication_factor", "is_internal")).alias("data"))
    documents["metadata"] = t.topic_metadata().select(
        "cluster_id", F.to_json(item).alias("value"), F.regexp_extract("topic", r"(\d+)$", 1).cast("long").alias("n"))
    root, marks, state, docs, stats, checkpoint = (scratch_path(t.spark, n) for n in ("landings", "marks", "state", "run-events", "stats", "checkpoint"))
    last = t.metric_rows().agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0]
    namespaces = write_and_reload(_edges(t).select(F.col("job_namespace").alias("namespace"), F.lit(True).alias("ok")).distinct(), "namespaces")
    step = cycle_plan.landing_step(
        t.spark, root, t.env_dim(), lambda cycle: namespaces, state_path=state, events_path=docs,
        opt=cycle_plan.Options(lookback_minutes=_WINDOW_MINUTES),
        on_stats=lambda cycle, df: df.write.mode("overwrite").parquet(f"{stats}/part={cycle}"))
    late: list[tuple] = []
    for cycle in ("1", "2", "3", "4"):
        announced, late = late, []
        for source, rows in documents.items():
            if source in _NEVER.get(cycle, ()):
                continue
            keep = F.lit(True) if source == "ksql_sources" else F.col("n") % 5 != int(cycle)
            _land_documents(rows.where(keep), f"{root}/{cycle}/{source}", "gzip")
            (late if source in _LATE.get(cycle, ()) else announced).append((cycle, last, source))
        t.spark.createDataFrame(announced, "cycle string, event_time string, source string").coalesce(1).write.mode("append").json(marks)
        stream_cycles.follow_sources(t.spark, marks, checkpoint, state, list(documents), step, patience=1).awaitTermination()
        # What a cycle was landed from is not read again once its state is published.
        for landed in tables.folders(t.spark, root):
            if state_store.is_published(t.spark, state, landed):
                tables.delete(t.spark, f"{root}/{landed}")
    return t.spark.read.parquet(stats).drop("part")


@query("T2_stateful_diff")
def _(t: Landed) -> DataFrame:
    return _actions(t, _follow_diff(t)[1])


@query("T2_keyed_diff")
def _(t: Landed) -> DataFrame:
    """The history as a stream with its diff in keyed state: two queries one after the other on one checkpoint, some
    health never sent. The mark of a year after the last one closes that."""
    at = F.make_timestamp_ntz(F.col("cycle"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("timestamp")
    history = t.job_history().select(F.col("cycle").cast("long").alias("cycle"), at.alias("at"), "namespace", "name", "fp")
    told = t.source_health().select(F.col("cycle").cast("long").alias("cycle"), at.alias("at"), "namespace", "ok")
    told = told.where("NOT (namespace = 'ns-2' AND cycle % 2 = 1)")
    jobs, health, out, checkpoint = (scratch_path(t.spark, n) for n in ("jobs", "health", "actions", "checkpoint"))
    for early in (True, False):
        chosen = F.col("cycle") <= 1995 if early else F.col("cycle") > 1995
        history.where(chosen).write.mode("append").parquet(jobs)
        told.where(chosen).write.mode("append").parquet(health)
        if not early:
            after = told.agg((F.max("cycle") + 1).alias("cycle")).select("cycle", at.alias("at"), F.lit("").alias("namespace"), F.lit(True).alias("ok"))
            after.write.mode("append").parquet(health)
        with stream_keyed.keyed_state(t.spark):
            actions = stream_keyed.follow_jobs(
                t.spark.readStream.schema(history.schema).parquet(jobs), t.spark.readStream.schema(told.schema).parquet(health))
            (
                actions.writeStream.format("parquet").outputMode("append").option("path", out)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
            )
    return t.spark.read.schema(stream_keyed.OUTPUT).parquet(out).withColumn("cycle", F.col("cycle").cast("int"))


@query("T3_sliding_throughput")
def _(t: Landed) -> DataFrame:
    with stream_keyed.keyed_state(t.spark):
        rows = _run_to_files(stream_usage.sliding_throughput(_stream_metrics(t)), "sliding")
    return rows.withColumns({"window_start": _stamp("window_start"), "window_end": _stamp("window_end")})


@query("T4_late_metrics")
def _(t: Landed) -> DataFrame:
    rows = _run_to_files(stream_usage.minute_totals(_stream_metrics(t), "cluster_id", "metric"), "minutes")
    return rows.select(_stamp("minute").alias("minute"), "cluster_id", "metric", F.round("value", 2).alias("value"))


@query("T4_repaired_minutes")
def _(t: Landed) -> DataFrame:
    """Three files by time; a twentieth of the first and of the second comes with the third, most of it behind the watermark."""
    _, one, _, three = _quarters(t)
    rows = t.metric_rows().select("event_id", "ts", "cluster_id", "metric", "value")
    third = F.when(F.col("ts") >= F.lit(three), 3).when(F.col("ts") >= F.lit(one), 2).otherwise(1)
    arrives = F.when(F.col("event_id") % 20 < 2, 3).otherwise(third)
    src, path, checkpoint = (scratch_path(t.spark, n) for n in ("metric-files", "repaired", "checkpoint"))
    minutes = stream_late.RepairedMinutes(t.spark, path, ["cluster_id", "metric"], unit="day")
    for k in (1, 2, 3):
        rows.where(arrives == k).write.mode("append").parquet(src)
        stream_late.follow_minutes(t.spark.readStream.schema(rows.schema).parquet(src), minutes, checkpoint).awaitTermination()
    return minutes.minutes().select(
        _stamp("minute").alias("minute"), "cluster_id", "metric", F.round("value", 2).alias("value"), "late_rows")


@query("T5_inactive_groups")
def _(t: Landed) -> DataFrame:
    with stream_usage.merged_sessions_early(t.spark):
        rows = _run_to_files(stream_usage.group_sessions(_stream_metrics(t)), "sessions")
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("active_from", "removed_at")})


@query("T5_silent_groups")
def _(t: Landed) -> DataFrame:
    """All spans: after the rows, a mark of the clock half an hour later, when every group has been silent long enough."""
    clock, out, checkpoint = (scratch_path(t.spark, n) for n in ("clock", "sessions", "checkpoint"))
    end = t.metric_rows().agg(F.max("ts").alias("ts"))
    for ticks in (end, end.select((F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("ts"))):
        ticks.write.mode("append").parquet(clock)
        with stream_usage.merged_sessions_early(t.spark):
            sessions = stream_usage.group_sessions(_stream_metrics(t), clock=t.spark.readStream.schema(end.schema).parquet(clock))
            (
                sessions.writeStream.format("parquet").outputMode("append").option("path", out)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
            )
    rows = t.spark.read.schema(sessions.schema).parquet(out)
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("active_from", "removed_at")})


@query("T5_group_spans_batch")
def _(t: Landed) -> DataFrame:
    rows = stream_usage.group_spans(t.metric_rows())
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("active_from", "removed_at")})


@query("T6_recover_state")
def _(t: Landed) -> DataFrame:
    return _actions(t, _follow_diff(t, stop_after="1997")[1])


@query("T7_orders_stream")
def _(t: Landed) -> DataFrame:
    source = _stream_table(t, "orders", "order_records").select(
        "ordertime", "orderid", "itemid", "orderunits", F.struct("city", "state", "zipcode").alias("address"))
    parts = []
    for stage in ("high_value_alerts", "medium_risk_orders"):
        out = scratch_path(t.spark, stage)
        stream_orders.start_stage(source, stage, out, scratch_path(t.spark, "checkpoint")).awaitTermination()
        parts.append(t.spark.read.schema(stream_orders.STAGES[stage](t.orders()).schema).parquet(out).select(
            F.lit(stage).alias("sink"), "ordertime", "orderid", "itemid", "orderunits", "city", "state", "risk_tier"))
    return parts[0].union(parts[1])


@query("T8_reload_dimension")
def _(t: Landed) -> DataFrame:
    dimension = stream_cycles.ReloadedDimension(lambda: _read_deployments(t))
    source = _stream_metrics(t).select("event_id", F.expr("'env-' || substring(cluster_id, 5)").alias("env_id"))
    out = scratch_path(t.spark, "stamped")
    stream_cycles.with_reloaded_dimension(source, dimension, "env_id", out, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "env_id", "env_name", "kafka_bootstrap")


def _quarters(t: Landed) -> list[datetime]:
    """The first second of the metric rows, and the ends of three quarters of their time."""
    lo, hi = t.metric_rows().agg(F.floor(F.unix_micros(F.min("ts")) / 1_000_000), F.floor(F.unix_micros(F.max("ts")) / 1_000_000)).first()
    return [datetime.fromtimestamp(lo + (hi - lo) * k // 4) for k in range(4)]


@query("T8_versions_as_of")
def _(t: Landed) -> DataFrame:
    """Records arrive in four batches, a tenth of each quarter only with the last one. The dimension is read before each batch:
    first all deployments, then a changed list, then an unreadable one, then another."""
    columns = "env_id string, env_name string, kafka_bootstrap string"
    names = columns.replace(" string", "").split(", ")
    old, new = _two_env_lists(t)
    third = old.withColumns({
        "env_name": F.concat("env_name", F.lit("-v3")), "kafka_bootstrap": F.when(F.col("env_ord") % 2 == 0, "").otherwise(F.col("kafka_bootstrap"))})
    readings = [lambda: old.select(names), lambda: new.select(names), lambda: t.spark.read.parquet(scratch_path(t.spark, "nowhere")),
                lambda: third.select(names)]
    starts = _quarters(t)
    dimension = VersionedDimension(t.spark, scratch_path(t.spark, "dimension"), columns)
    src, out, checkpoint = (scratch_path(t.spark, n) for n in ("records", "stamped", "checkpoint"))
    quarter = F.lit(0)
    for k, start in enumerate(starts):
        quarter = F.when(F.col("ts") >= F.lit(start), k).otherwise(quarter)
    records = t.metric_rows().select("event_id", F.expr("'env-' || substring(cluster_id, 5)").alias("env_id"), "ts")
    arrives = F.when(F.col("event_id") % 10 == 0, 3).otherwise(quarter)
    for k, start in enumerate(starts):
        records.where(arrives == k).write.mode("append").parquet(src)
        stream_dimension.stamp_stream(
            t.spark.readStream.schema(records.schema).parquet(src), dimension, "env_id", "ts", ["env_name", "kafka_bootstrap"],
            out, checkpoint, reload=lambda batch_id, k=k, start=start: dimension.load(readings[k], start),
        ).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "env_id", "env_name", "kafka_bootstrap")


@query("T9_at_least_once_emit")
def _(t: Landed) -> DataFrame:
    """Deliveries of jobs whose name ends in 7 always fail, so those jobs are sent every time."""
    return _actions(t, _follow_diff(t, undelivered=lambda sent: sent.where(F.col("job_name").endswith("7")))[1])


@query("T9_delivery_ledger")
def _(t: Landed) -> DataFrame:
    """Every document of the history and the round it arrived in. Each year is a round. Documents of jobs whose name ends in 7
    do not arrive the first time; the round of 1995 dies when half of its documents are out, and is run again."""
    actions = write_and_reload(diff.diff_history(t.job_history(), t.source_health()), "actions")
    documents = actions.where(F.col("action").isin(diff.EMIT, diff.ABORT)).select(
        F.col("cycle").cast("string").alias("cycle"), "namespace", "name", "action",
        identity.stable_run_id(F.col("namespace"), F.col("name"), F.col("cycle").cast("string")).alias("run_id"), F.lit(0).alias("part"))
    documents = write_and_reload(documents, "documents")
    ledger = Ledger(t.spark, scratch_path(t.spark, "ledger"), "struct<namespace: string, name: string, action: string>")
    years = [r.cycle for r in documents.select("cycle").distinct().orderBy("cycle").collect()]
    sent = scratch_path(t.spark, "sent")

    def deliver(due: DataFrame) -> DataFrame:
        tried = due.withColumn("arrived", ~F.col("document.name").endswith("7") | (F.col("tries") > 0))
        tried.where("arrived").select("cycle", "run_id").write.mode("append").parquet(sent)
        return tried

    def dies(due: DataFrame) -> DataFrame:
        deliver(due.where(F.crc32("run_id") % 2 == 0))
        raise ConnectionError("half-way")

    for year in years:
        own = documents.where(F.col("cycle") == year)
        ledger.put(own.select("run_id", "part", F.struct("namespace", "name", "action").alias("document")), year)
        if year == "1995":
            try:
                ledger.send(int(year), dies)
            except ConnectionError:
                pass
        ledger.send(int(year), deliver)
    shown = ledger.documents().select("cycle", "run_id", "document.*")
    return shown.join(ledger.entries(), ["cycle", "run_id"]).select(
        F.col("cycle").cast("int").alias("cycle"), "namespace", "name", "action", F.col("arrived_round").cast("int").alias("arrived_round"), "tries")


# --- Schema registry ----------------------------------------------------------------------------

@query("X1_flatten_schemas")
def _(t: Landed) -> DataFrame:
    return registry.flatten_schemas(t.schema_subjects()).select(
        "env_id", "subject", "version", F.array_join("names", ".").alias("field"), "depth", "pos", "name",
        "type", "description")


@query("X2_schema_drift")
def _(t: Landed) -> DataFrame:
    """Every part's schema against the schema of the next part, which is often of another type."""
    raw = t.view("schema_subjects_raw")
    subjects = t.schema_subjects().join(raw.select("env_id", "subject", "version", "partkey"), ["env_id", "subject", "version"])
    own = subjects.select(F.lit("all").alias("env_id"), F.lit("part").alias("subject"),
                          F.col("partkey").cast("int").alias("version"), "schema_type", "schema_text")
    fields = write_and_reload(registry.flatten_schemas(own), "fields")

    def keyed(df: DataFrame, version) -> DataFrame:
        return df.withColumn("subject", F.concat_ws("-", F.col("subject"), version.cast("string")))

    old = keyed(fields, F.col("version"))
    new = keyed(fields.where("version > 0"), F.col("version") - 1)
    return registry.schema_drift(old, new).select(
        "subject", F.array_join("names", ".").alias("field"), "old_type", "new_type", "change")
