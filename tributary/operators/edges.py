"""The edge table: one row per (input, output) pair of a job, with topology and a total order.

Builders return draft rows (`draft_edges`); `lineage_edges` unions them, stamps topology from
the environment dimension and adds `edge_seq`. That struct orders edges: global sources first,
then environments in their configured order, builders in a fixed order, then names and
positions. It is a value, so it is the same on every run and every cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import DATASET_TYPES, TOPIC
from tributary.functions.identity import cloud_region
from tributary.schemas import EDGE_COLUMNS, TOPOLOGY_COLUMNS

# Order of builders inside one scope. Only self-managed connectors and persistent queries have
# no environment, so the numbers never clash within a scope.
BUILDERS = {"connect": 1, "ksql": 2, "flink": 2, "producer": 3, "group": 4, "tableflow": 5}


def draft_edges(
    df: DataFrame, *, builder: str, scope: Column | None,
    source: tuple[Column, Column], target: tuple[Column, Column],
    job: tuple[Column, Column, Column], target_namespace: Column | None = None,
    pos_in: Column | None = None, pos_out: Column | None = None,
) -> DataFrame:
    """Project rows of one source to draft edges. `scope` is the env_id or cluster_id that
    finds the topology, None for sources outside any environment; `source` and `target` are
    (name, type); `job` is (name, type, namespace)."""
    null = F.lit(None).cast("string")
    zero = F.lit(0)
    return df.select(
        source[0].alias("source_name"), source[1].alias("source_type"),
        target[0].alias("target_name"), target[1].alias("target_type"),
        job[0].alias("job_name"), job[1].alias("job_type"), job[2].alias("job_namespace"),
        (null if target_namespace is None else target_namespace).alias("target_namespace"),
        (null if scope is None else scope).alias("scope_key"),
        F.lit(BUILDERS[builder]).alias("builder"),
        (zero if pos_in is None else pos_in).alias("pos_in"),
        (zero if pos_out is None else pos_out).alias("pos_out"),
    )


def environment_topology(env_dim: DataFrame) -> DataFrame:
    """One row per scope key (env_id and cluster_id both find the row)."""
    cloud, region = cloud_region(F.col("kafka_bootstrap"))
    return env_dim.select(
        F.explode(F.array_distinct(F.array("env_id", "cluster_id"))).alias("scope_key"),
        "env_ord", "kafka_bootstrap", "env_id", "env_name", "cluster_id", "cluster_name",
        cloud.alias("cloud"), region.alias("region"),
    )


def stamp_topology(drafts: DataFrame, env_dim: DataFrame) -> DataFrame:
    """Left join: rows without a scope key keep NULL topology. The dimension is a small file, so
    its size statistics make this a broadcast join; a larger one falls back to a shuffled join
    whose hot scopes the adaptive skew join splits."""
    return drafts.join(environment_topology(env_dim), "scope_key", "left")


def _with_order(stamped: DataFrame) -> DataFrame:
    seq = F.struct(
        F.when(F.col("scope_key").isNull(), 0).otherwise(1).alias("scope"),
        F.coalesce("env_ord", F.lit(0)).cast("int").alias("env_ord"),
        F.col("builder"), F.col("job_namespace").alias("namespace"),
        F.col("job_name").alias("name"), F.col("pos_in"), F.col("pos_out"),
        F.col("source_name").alias("source"), F.col("target_name").alias("target"),
    )
    return stamped.select(*EDGE_COLUMNS, seq.alias("edge_seq"))


def lineage_edges(drafts: list[DataFrame], env_dim: DataFrame) -> DataFrame:
    """Union of all builders with topology and order; no shuffle beyond the builders' own."""
    return _with_order(stamp_topology(reduce(DataFrame.unionByName, drafts), env_dim))


def graph_topics(edges: DataFrame) -> DataFrame:
    """Distinct (env_id, cluster_id, topic) over both ends of all edges."""
    ends = F.array(
        F.when(F.col("source_type") == TOPIC, F.col("source_name")),
        F.when(F.col("target_type") == TOPIC, F.col("target_name")),
    )
    return (
        edges.select("env_id", "cluster_id", F.explode(ends).alias("topic"))
        .where("topic IS NOT NULL").distinct()
    )


def dataset_endpoints(edges: DataFrame, *keep: str, types: tuple[str, ...] = DATASET_TYPES) -> DataFrame:
    """Both ends of every edge as rows (side, dataset_type, dataset_name, declared namespace);
    external systems and consumer groups are not datasets and fall away."""
    end = F.array(
        F.struct(
            F.lit("input").alias("side"), F.col("source_type").alias("dataset_type"),
            F.col("source_name").alias("dataset_name"),
            F.lit(None).cast("string").alias("declared_namespace"),
        ),
        F.struct(
            F.lit("output").alias("side"), F.col("target_type").alias("dataset_type"),
            F.col("target_name").alias("dataset_name"),
            F.col("target_namespace").alias("declared_namespace"),
        ),
    )
    wanted = F.filter(end, lambda e: e["dataset_type"].isin(*types))
    return edges.select("job_namespace", "job_name", "job_type", *keep, F.inline(wanted))


def edge_listing(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.col("job_name").alias("job"), F.col("job_type").alias("type"),
        F.col("source_name").alias("source"), F.col("target_name").alias("target"),
    )


def facet_filter(rows: DataFrame, **wanted: str) -> DataFrame:
    """Rows whose topology matches, e.g. `facet_filter(jobs, env_id="env-1", region="zone-1")`."""
    unknown = set(wanted) - set(TOPOLOGY_COLUMNS)
    if unknown:
        raise ValueError(f"not a topology column: {sorted(unknown)}")
    for name, value in wanted.items():
        rows = rows.where(F.col(name) == value)
    return rows


def select_by_prefix(inventory: DataFrame, prefix: str, column: str = "name") -> DataFrame:
    return inventory.where(F.col(column).startswith(prefix))
