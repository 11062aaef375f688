"""Metric rows: who reads, who writes, how much.

Bindings stay in long form, one distinct row per (id, topic): the distinct combines on the map
side, so a client with a third of all rows costs each task a few rows, and no list of unknown
length is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import (
    DEFAULT_LOOKBACK_MINUTES, EXTERNAL, GROUP, INTERNAL_GROUP_PREFIXES,
    INTERNAL_PRODUCER_PREFIXES, LAG_METRIC, RECEIVED_BYTES, THROUGHPUT_COLUMNS, TOPIC,
)
from tributary.functions.text import floor_minute, non_empty, starts_with_any
from tributary.operators.edges import draft_edges


def lookback(rows: DataFrame, as_of: Column, minutes: int = DEFAULT_LOOKBACK_MINUTES) -> DataFrame:
    """Rows of the last full `minutes` minutes before `as_of`: start included, end excluded."""
    end = floor_minute(as_of)
    return rows.where((F.col("ts") >= end - F.make_dt_interval(mins=F.lit(minutes))) & (F.col("ts") < end))


def cluster_filter(rows: DataFrame, cluster_id: str) -> DataFrame:
    return rows.where(F.col("cluster_id") == cluster_id)


def valid_bindings(rows: DataFrame, id_column: str) -> DataFrame:
    """Rows with an id and a topic. The value does not matter: lag 0 is an active group."""
    return rows.where(non_empty(id_column).isNotNull() & non_empty("topic").isNotNull())


def valid_throughput(rows: DataFrame) -> DataFrame:
    """Rows of the four volume metrics with a topic and a value; 0 is a value."""
    return rows.where(
        F.col("metric").isin(*THROUGHPUT_COLUMNS)
        & non_empty("topic").isNotNull() & F.col("value").isNotNull()
    )


def external_groups(rows: DataFrame, extra_prefixes=()) -> DataFrame:
    return rows.where(
        ~starts_with_any(F.col("consumer_group_id"), (*INTERNAL_GROUP_PREFIXES, *extra_prefixes))
    )


def external_producers(rows: DataFrame, extra_prefixes=()) -> DataFrame:
    return rows.where(
        ~starts_with_any(F.col("client_id"), (*INTERNAL_PRODUCER_PREFIXES, *extra_prefixes))
    )


def id_cuts(ids: DataFrame, lengths: list[int], salts: int) -> DataFrame:
    """Each `_id` cut to each of the lengths that it has, with a salt."""
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_id"))
    return ids.select(
        "_id", F.pmod(F.hash("_id"), F.lit(salts)).alias("_salt"),
        F.explode(F.transform(fits, lambda n: F.substring("_id", F.lit(1), n))).alias("prefix"),
    )


def prefix_anti_join(rows: DataFrame, prefixes: DataFrame, column: str, salts: int = 16) -> DataFrame:
    """Rows whose `column` starts with none of the values in `prefixes(prefix)`.

    Works for prefix tables of any size without comparing every row with every prefix: each distinct id is
    cut to the lengths that occur among the prefixes (a handful, however many prefixes there are), the
    cuts meet the table in an equi-join, and the ids found are removed from the rows with an anti join. Short
    prefixes are shared by very many ids, hence the salt on both sides.
    """
    known = prefixes.select("prefix").where("prefix IS NOT NULL").distinct()
    # At most as many numbers as the longest prefix has characters.
    lengths = sorted(r[0] for r in known.select(F.length("prefix")).distinct().collect())
    if not lengths:
        return rows
    ids = rows.select(F.col(column).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    spread = known.select("prefix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    matched = id_cuts(ids, lengths, salts).join(spread, ["prefix", "_salt"], "left_semi")
    matched = matched.select(F.col("_id").alias(column)).distinct()
    return rows.join(matched, column, "left_anti")


def consumer_groups(rows: DataFrame, extra_prefixes=()) -> DataFrame:
    """Distinct (cluster_id, consumer_group_id, topic) of external groups."""
    lag = rows.where(F.col("metric") == LAG_METRIC)
    bound = external_groups(valid_bindings(lag, "consumer_group_id"), extra_prefixes)
    return bound.select("cluster_id", "consumer_group_id", "topic").distinct()


def producers(rows: DataFrame, extra_prefixes=()) -> DataFrame:
    """Distinct (cluster_id, client_id, topic) of external producers."""
    received = rows.where(F.col("metric") == RECEIVED_BYTES)
    bound = external_producers(valid_bindings(received, "client_id"), extra_prefixes)
    return bound.select("cluster_id", "client_id", "topic").distinct()


def throughput_sums() -> list[Column]:
    """Four sums; every value loses its fraction before it is added."""
    whole = F.expr("try_cast(value AS bigint)")
    return [
        F.coalesce(F.sum(F.when(F.col("metric") == metric, whole)), F.lit(0)).alias(name)
        for metric, name in THROUGHPUT_COLUMNS.items()
    ]


def topic_throughput(rows: DataFrame, window_minutes: int = DEFAULT_LOOKBACK_MINUTES) -> DataFrame:
    """Bytes and records in and out per (cluster, topic); topics with only zeros are kept."""
    return (
        valid_throughput(rows).groupBy("cluster_id", "topic").agg(*throughput_sums())
        .withColumn("window_minutes", F.lit(window_minutes))
    )


def busiest_topics(throughput: DataFrame, k: int, by: str = "bytes_in") -> DataFrame:
    """Top-k report; ties are broken by cluster and topic."""
    return throughput.orderBy(F.col(by).desc(), "cluster_id", "topic").limit(k)


def metric_minute_rollup(rows: DataFrame, *keys: str) -> DataFrame:
    """Sum per minute and key."""
    return rows.groupBy(floor_minute(F.col("ts")).alias("minute"), *keys).agg(
        F.sum("value").alias("value"),
    )


def producer_edges(bindings: DataFrame) -> DataFrame:
    return draft_edges(
        bindings, builder="producer", scope=F.col("cluster_id"),
        source=(F.col("client_id"), F.lit(EXTERNAL)), target=(F.col("topic"), F.lit(TOPIC)),
        job=(F.col("client_id"), F.lit("kafka_producer"),
             F.concat(F.lit("kafka-producer://"), "cluster_id")),
    )


def group_edges(bindings: DataFrame) -> DataFrame:
    return draft_edges(
        bindings, builder="group", scope=F.col("cluster_id"),
        source=(F.col("topic"), F.lit(TOPIC)), target=(F.col("consumer_group_id"), F.lit(GROUP)),
        job=(F.col("consumer_group_id"), F.lit("kafka_consumer_group"),
             F.concat(F.lit("kafka-consumer-group://"), "cluster_id")),
    )
