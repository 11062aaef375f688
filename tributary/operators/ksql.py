"""Persistent queries: source resolution and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import ACTIVE_PERSISTENT_QUERY_STATES, TOPIC
from tributary.operators.edges import draft_edges


def resolve_ksql_topics(queries: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per (query, source): the source's topic, or its name when nothing is known of it.
    Names match in upper case within one cluster; the list of sinks stays on the row."""
    long = queries.select(
        "query_id", "ksql_cluster_id", "state", "sink_topics",
        F.posexplode("sources").alias("pos_in", "source"),
    ).withColumn("_name", F.upper("source"))
    known = sources.select("ksql_cluster_id", F.col("name").alias("_name"), F.col("topic").alias("_topic"))
    return long.join(known, ["ksql_cluster_id", "_name"], "left").select(
        "query_id", "ksql_cluster_id", "state", "sink_topics", "pos_in", "source",
        F.coalesce("_topic", "source").alias("source_topic"),
    )


def drop_self_reference(resolved: DataFrame) -> DataFrame:
    """Sources that are also sinks of the same query fall away, after resolution."""
    return resolved.where(~F.array_contains("sink_topics", F.col("source_topic")))


def ksql_active(rows: DataFrame) -> DataFrame:
    return rows.where(F.upper("state").isin(*ACTIVE_PERSISTENT_QUERY_STATES))


def ksql_edges(queries: DataFrame, sources: DataFrame) -> DataFrame:
    """Queries without a source or a sink left have no edges; the state filter runs first."""
    rows = drop_self_reference(resolve_ksql_topics(ksql_active(queries), sources))
    pairs = rows.select(
        "query_id", "ksql_cluster_id", "source_topic", "pos_in",
        F.posexplode("sink_topics").alias("pos_out", "sink_topic"),
    )
    return draft_edges(
        pairs, builder="ksql", scope=None,
        source=(F.col("source_topic"), F.lit(TOPIC)), target=(F.col("sink_topic"), F.lit(TOPIC)),
        job=(F.col("query_id"), F.lit("ksqldb_query"),
             F.concat(F.lit("ksqldb://"), "ksql_cluster_id")),
        pos_in=F.col("pos_in"), pos_out=F.col("pos_out"),
    )
