"""Topics synced to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import INACTIVE_TABLE_SYNC_STATES, TABLE, TOPIC
from tributary.functions.identity import synced_table
from tributary.operators.edges import draft_edges


def tableflow_active(topics: DataFrame) -> DataFrame:
    """Suspended syncs stay."""
    return topics.where(~F.upper("status").isin(*INACTIVE_TABLE_SYNC_STATES))


def tableflow_edges(topics: DataFrame, region: str | None = None, database: str | None = None) -> DataFrame:
    namespace, table = synced_table(F.col("topic_name"), region, database)
    return draft_edges(
        tableflow_active(topics), builder="tableflow", scope=F.col("env_id"),
        source=(F.col("topic_name"), F.lit(TOPIC)), target=(table, F.lit(TABLE)),
        target_namespace=namespace,
        job=(F.col("topic_name"), F.lit("tableflow"), F.concat(F.lit("tableflow://"), "env_id")),
    )
