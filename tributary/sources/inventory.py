"""Readers for landed inventory payloads, and the health of their sources.

A landing folder holds JSON documents as text, one per line (or one per file with
`whole_files=True`). Context the payload itself does not carry (env_id, cluster_id,
connect_cluster, ksql_cluster_id, kind, page) comes from partition folders, so filters on it
prune files. Any number of documents per source is fine; none has to be complete.

A document that is no JSON, is cut off, or has another shape than its source sends (an error body, a
page of HTML) is broken. It gives no rows; `payload_health` counts it, and the namespaces of its jobs count as
failed in that cycle, as nobody can tell what was in it. Readers take a path, or the documents of `parsed`
where rows and health are wanted from one reading.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import schemas
from tributary.fixed_values import DEFAULT_SCHEMA_TYPE, LAG_METRIC, RECEIVED_BYTES
from tributary.functions.text import computed, first_non_empty, non_empty, starts_with_any

CONTEXT = ("env_id", "cluster_id", "connect_cluster", "ksql_cluster_id", "kind", "page", "metric")
_CORRUPT = "_corrupt_record"
# Keys that only an error body has; a page without data and without these is empty.
_ERRORS = ("error", "errors", "error_code")


@dataclass(frozen=True)
class Source:
    """Type of a document, the brackets around it, what makes it whole, and the namespace of the jobs it
    is about (None: it only feeds facets)."""

    item: str
    bounds: str
    whole: str
    namespace: str | None = None


# What the namespaces of a source's jobs begin with.
SCHEMES = {
    "connect": ("kafka-connect://",), "flink": ("flink://",), "metrics": ("kafka-producer://", "kafka-consumer-group://"),
    "ksql_queries": ("ksqldb://",), "ksql_sources": ("ksqldb://",), "tableflow": ("tableflow://",),
}


def _list(fields: str, namespace: str) -> Source:
    return Source(f"array<struct<{fields}>>", "[]", "forall(doc, x -> x IS NOT NULL)", namespace)


def _object(fields: str, namespace: str | None = None, whole: str = "true") -> Source:
    return Source(f"struct<{fields}, {_CORRUPT}: string>", "{}", f"doc.{_CORRUPT} IS NULL AND {whole}", namespace)


def _page(fields: str, namespace: str | None = None) -> Source:
    errors = ", ".join(f"{e}: string" for e in _ERRORS)
    whole = " AND ".join(f"doc.{e} IS NULL" for e in _ERRORS)
    return _object(f"data: array<struct<{fields}>>, {errors}", namespace, f"(doc.data IS NOT NULL OR ({whole}))")


SOURCES = {
    "connect": Source(
        schemas.CONNECTOR_DOCUMENT, "{}", "forall(map_values(doc), x -> x IS NOT NULL)",
        "'kafka-connect://' || coalesce(connect_cluster, env_id)"),
    "flink": _list("name: string, statement: string, status: string, compute_pool: string", "'flink://' || env_id"),
    "metrics": _page(
        schemas.METRIC_ROW,
        f"CASE metric WHEN '{RECEIVED_BYTES}' THEN 'kafka-producer://' || cluster_id"
        f" WHEN '{LAG_METRIC}' THEN 'kafka-consumer-group://' || cluster_id END"),
    "ksql_sources": _list("sourceDescriptions: array<struct<name: string, topic: string>>", "'ksqldb://' || ksql_cluster_id"),
    "ksql_queries": _list(
        "queries: array<struct<id: struct<queryId: string>, state: string, queryString: string,"
        " sinkKafkaTopics: array<string>, sinks: array<string>, sources: array<string>>>",
        "'ksqldb://' || ksql_cluster_id"),
    "tableflow": _list(
        "topic_name: string, display_name: string, name: string, phase: string, status: string", "'tableflow://' || env_id"),
    "metadata": _page("topic_name: string, partitions_count: int, replication_factor: int, is_internal: boolean"),
    "subjects": _object("subject: string, version: int, schemaType: string, schema: string"),
    "environments": _object(
        "environments: array<struct<env_id: string, env_name: string, cluster_id: string, cluster_name: string,"
        " kafka_bootstrap: string, env_ord: int>>"),
}


def parsed(spark: SparkSession, path: str, source: str, whole_files: bool = False) -> DataFrame:
    """Context columns, `doc` (the document's content, NULL if it is broken) and `ok` (it is whole) of every document.
    A blank line is no document, a blank file (`whole_files`) a broken one; a file without a byte is not seen, so a namespace
    that has nothing else has no health and counts as failed."""
    kind = SOURCES[source]
    docs = spark.read.text(path, wholetext=whole_files)
    if not whole_files:
        docs = docs.where(F.trim(F.col("value")) != "")
    first, last = kind.bounds
    corrupt = {"columnNameOfCorruptRecord": _CORRUPT}
    content = docs.select(
        *[(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in CONTEXT],
        F.from_json("value", kind.item, corrupt).alias("doc"),
        F.col("value").rlike(rf"(?s)^\s*\{first}.*\{last}\s*$").alias("closed"),
    )
    ok = F.coalesce(F.col("closed") & F.col("doc").isNotNull() & F.expr(kind.whole), F.lit(False))
    # No filter: it would be pushed below the parser and parse once more.
    return content.select(*CONTEXT, "doc", ok.alias("ok")).withColumn("doc", F.when(F.col("ok"), F.col("doc")))


def payload_health(docs: DataFrame, source: str) -> DataFrame:
    """(namespace, source, ok, documents, bad_documents): one row for each namespace that the source's documents
    are about. Documents without context, or of sources that no job comes from, have a NULL namespace."""
    namespace = SOURCES[source].namespace
    name = F.lit(None).cast("string") if namespace is None else F.expr(namespace)
    return docs.groupBy(name.alias("namespace")).agg(
        F.count("*").alias("documents"), F.count_if(~F.col("ok")).alias("bad_documents"),
    ).select("namespace", F.lit(source).alias("source"), (F.col("bad_documents") == 0).alias("ok"), "documents", "bad_documents")


def without_sources(health: DataFrame, missing: frozenset[str]) -> DataFrame:
    """Health in which the namespaces of sources that were not landed have failed."""
    schemes = [scheme for source in sorted(missing) for scheme in SCHEMES.get(source, ())]
    return health.select("namespace", (F.col("ok") & ~starts_with_any(F.col("namespace"), schemes)).alias("ok"))


def read_health(spark: SparkSession, paths: dict[str, str], whole_files: bool = False) -> DataFrame:
    """`payload_health` of several sources (name -> landing folder)."""
    return reduce(DataFrame.union, [payload_health(parsed(spark, p, s, whole_files), s) for s, p in paths.items()])


def _documents(spark: SparkSession, path: str | DataFrame, source: str, whole_files: bool) -> DataFrame:
    return path if isinstance(path, DataFrame) else parsed(spark, path, source, whole_files)


def _or_empty(c: Column, array_type: str) -> Column:
    return F.coalesce(c, F.array().cast(array_type))


def read_connect_inventory(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    """Connectors, managed (env_id, cluster_id set) or self-managed (connect_cluster set)."""
    docs = _documents(spark, path, "connect", whole_files)
    rows = docs.select(
        "env_id", "cluster_id", "connect_cluster",
        F.inline(computed(F.map_entries("doc"))).alias("name", "data"),
    )
    owner = F.coalesce("connect_cluster", "cluster_id")
    return rows.select(
        F.concat_ws(":", owner, "name").alias("id"),
        "name",
        F.coalesce("data.status.connector.state", F.lit("UNKNOWN")).alias("status"),
        F.lower(F.coalesce("data.info.type", F.lit("source"))).alias("type"),
        F.coalesce("data.info.config", F.create_map().cast("map<string,string>")).alias("config"),
        "env_id", "cluster_id", "connect_cluster",
    )


def read_flink_statements(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    docs = _documents(spark, path, "flink", whole_files)
    rows = docs.select("env_id", F.inline(computed(F.col("doc"))))
    return rows.where(non_empty("name").isNotNull() & non_empty("statement").isNotNull()).select(
        "name", "env_id",
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        F.col("statement").alias("sql_text"),
        F.coalesce("compute_pool", F.lit("")).alias("compute_pool"),
    )


def read_metric_rows(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    """All rows of all pages. The metric asked for and the cluster are partition folders."""
    docs = _documents(spark, path, "metrics", whole_files)
    rows = docs.select(
        "cluster_id", "metric",
        F.explode(computed(F.col("doc.data"))).alias("r"),
    )
    return rows.select(
        "cluster_id", F.col("metric"),
        F.try_to_timestamp(F.col("r")["timestamp"]).alias("ts"),
        F.col("r")["metric.topic"].alias("topic"),
        F.col("r")["metric.consumer_group_id"].alias("consumer_group_id"),
        F.col("r")["metric.client_id"].alias("client_id"),
        F.col("r")["value"].alias("value"),
    )


def read_ksql_sources(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    """(ksql_cluster_id, name, topic): upper-cased stream/table names and their topics.

    Tables (`kind=tables`) are read after streams, and a later row for a name replaces an
    earlier one.
    """
    docs = _documents(spark, path, "ksql_sources", whole_files)
    items = docs.select(
        "ksql_cluster_id",
        (F.coalesce("kind", F.lit("")) == "tables").alias("is_table"),
        F.coalesce(F.col("page").cast("int"), F.lit(0)).alias("page"),
        F.posexplode(computed(F.col("doc"))).alias("item_pos", "item"),
    )
    rows = items.select(
        "ksql_cluster_id", "is_table", "page", "item_pos",
        F.posexplode("item.sourceDescriptions").alias("pos", "d"),
    ).select("*", F.upper("d.name").alias("name"), F.col("d.topic").alias("topic"))
    order = F.struct("is_table", "page", "item_pos", "pos")
    return (
        rows.where(non_empty("name").isNotNull() & non_empty("topic").isNotNull())
        .groupBy("ksql_cluster_id", "name").agg(F.max_by("topic", order).alias("topic"))
    )


def read_ksql_queries(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    docs = _documents(spark, path, "ksql_queries", whole_files)
    rows = (
        docs.select("ksql_cluster_id", F.inline(computed(F.col("doc"))))
        .select("ksql_cluster_id", F.inline("queries"))
        .where(non_empty("id.queryId").isNotNull())
    )
    kafka_sinks = F.when(F.size("sinkKafkaTopics") > 0, F.col("sinkKafkaTopics"))
    return rows.select(
        F.col("id.queryId").alias("query_id"), "ksql_cluster_id",
        F.coalesce("state", F.lit("UNKNOWN")).alias("state"),
        F.coalesce("queryString", F.lit("")).alias("sql_text"),
        _or_empty(F.coalesce(kafka_sinks, F.col("sinks")), "array<string>").alias("sink_topics"),
        _or_empty(F.col("sources"), "array<string>").alias("sources"),
    )


def read_tableflow_topics(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    docs = _documents(spark, path, "tableflow", whole_files)
    rows = docs.select("env_id", F.inline(computed(F.col("doc"))))
    return rows.select(
        "env_id",
        first_non_empty("topic_name", "display_name", "name").alias("topic_name"),
        F.coalesce(non_empty("phase"), non_empty("status"), F.lit("UNKNOWN")).alias("status"),
    ).where("topic_name IS NOT NULL")


def read_topic_metadata(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    docs = _documents(spark, path, "metadata", whole_files)
    rows = docs.select(
        "cluster_id", F.inline(computed(F.col("doc.data"))),
    )
    return rows.where(non_empty("topic_name").isNotNull()).select(
        "cluster_id", F.col("topic_name").alias("topic"),
        F.coalesce("partitions_count", F.lit(0)).alias("partitions"),
        F.coalesce("replication_factor", F.lit(0)).alias("replication_factor"),
        F.coalesce("is_internal", F.lit(False)).alias("is_internal"),
    )


def read_schema_subjects(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    """Every landed version of every subject."""
    docs = _documents(spark, path, "subjects", whole_files)
    rows = docs.select("env_id", F.inline(computed(F.array("doc"))))
    return rows.where(non_empty("subject").isNotNull()).select(
        "env_id", "subject", "version",
        F.upper(F.coalesce("schemaType", F.lit(DEFAULT_SCHEMA_TYPE))).alias("schema_type"),
        F.coalesce("schema", F.lit("")).alias("schema_text"),
    )


def read_environments(spark: SparkSession, path: str | DataFrame, whole_files: bool = False) -> DataFrame:
    """Environment/cluster pairs. `env_ord` is the explicit order, else the list position."""
    docs = _documents(spark, path, "environments", whole_files)
    rows = docs.select(
        F.posexplode(computed(F.col("doc.environments"))).alias("pos", "e"),
    )
    return rows.select(
        F.col("e.env_id").alias("env_id"),
        F.coalesce("e.env_name", F.lit("")).alias("env_name"),
        F.col("e.cluster_id").alias("cluster_id"),
        F.coalesce("e.cluster_name", F.lit("")).alias("cluster_name"),
        F.col("e.kafka_bootstrap").alias("kafka_bootstrap"),
        F.coalesce("e.env_ord", "pos").cast("int").alias("env_ord"),
    )
