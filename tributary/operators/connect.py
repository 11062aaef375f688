"""Connectors: topic bindings and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import EXTERNAL, TOPIC
from tributary.functions.text import first_non_empty, split_list
from tributary.operators.edges import draft_edges


def _config(key: str):
    return F.try_element_at("config", F.lit(key))


def connector_topics(connectors: DataFrame) -> DataFrame:
    """One row per (connector, topic), with its position in the configured list."""
    produced = first_non_empty(_config("kafka.topic"), _config("topic"))
    consumed = first_non_empty(_config("topics"), _config("kafka.topics"), _config("topic"))
    raw = F.when(F.col("type") == "source", produced).when(F.col("type") == "sink", consumed)
    return connectors.select(
        "name", "type", "env_id", "cluster_id", "connect_cluster",
        F.posexplode(split_list(raw)).alias("pos", "topic"),
    )


def connector_edges(connectors: DataFrame) -> DataFrame:
    """Drafts of managed and self-managed connectors. Status is not looked at: paused and
    failed connectors keep their edges."""
    rows = connector_topics(connectors)
    is_source = F.col("type") == "source"
    name, topic = F.col("name"), F.col("topic")
    self_managed = F.col("connect_cluster").isNotNull()
    return draft_edges(
        rows, builder="connect",
        scope=F.when(~self_managed, F.coalesce("cluster_id", "env_id")),
        source=(F.when(is_source, name).otherwise(topic),
                F.when(is_source, EXTERNAL).otherwise(TOPIC)),
        target=(F.when(is_source, topic).otherwise(name),
                F.when(is_source, TOPIC).otherwise(EXTERNAL)),
        job=(name,
             F.when(is_source, "kafka_connect_source").otherwise("kafka_connect_sink"),
             F.concat(F.lit("kafka-connect://"), F.coalesce("connect_cluster", "env_id"))),
        pos_in=F.col("pos"),
    )
