"""One cycle: landed inventory -> graph -> events -> diff -> documents and state."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixed_values import DEFAULT_LOOKBACK_MINUTES
from tributary.operators import (
    connect, diff, edges, events, ksql, registry, rollups, statements, tableflow, topics, usage,
)
from tributary.schemas import JOB_KEY
from tributary.session import drop, scratch_tables, write_and_reload
from tributary.sources import inventory, run_events, state as state_store, tables


@dataclass
class Inventory:
    """What was landed for a cycle. Sources that are not used stay None."""

    env_dim: DataFrame
    connectors: DataFrame | None = None
    statements: DataFrame | None = None
    metrics: DataFrame | None = None
    ksql_queries: DataFrame | None = None
    ksql_sources: DataFrame | None = None
    tableflow_topics: DataFrame | None = None
    subjects: DataFrame | None = None
    topic_metadata: DataFrame | None = None
    # What the landed documents themselves say about their sources (namespace, ok).
    payload_health: DataFrame | None = None


def read_landing(
    spark: SparkSession, root: str, env_dim: DataFrame | None = None, whole_files: bool = False, missing: frozenset[str] = frozenset(),
) -> Inventory:
    """The inventory of a landing folder: one folder for each source (`inventory.SOURCES`); those that are not there, or
    are `missing`, stay None. Every source is parsed once, into a table that rows and health are read from."""
    landed = {
        source: write_and_reload(inventory.parsed(spark, f"{root}/{source}", source, whole_files), source)
        for source in inventory.SOURCES if source not in missing and tables.exists(spark, f"{root}/{source}")
    }

    def rows(source: str, read) -> DataFrame | None:
        return read(spark, landed[source]) if source in landed else None

    health = [inventory.payload_health(docs, source) for source, docs in landed.items()]
    return Inventory(
        env_dim=rows("environments", inventory.read_environments) if env_dim is None else env_dim,
        connectors=rows("connect", inventory.read_connect_inventory),
        statements=rows("flink", inventory.read_flink_statements),
        metrics=rows("metrics", inventory.read_metric_rows),
        ksql_queries=rows("ksql_queries", inventory.read_ksql_queries),
        ksql_sources=rows("ksql_sources", inventory.read_ksql_sources),
        tableflow_topics=rows("tableflow", inventory.read_tableflow_topics),
        subjects=rows("subjects", inventory.read_schema_subjects),
        topic_metadata=rows("metadata", inventory.read_topic_metadata),
        payload_health=reduce(DataFrame.union, health) if health else None,
    )


@dataclass
class Options:
    """Settings of a cycle; none of them is a secret."""

    producer: str = "tributary"
    fallback_bootstrap: str = ""
    table_region: str | None = None
    table_database: str | None = None
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES
    # End of the metric window (a time as text). None: in a cycle its event time, in a graph alone every landed row.
    as_of: str | None = None
    group_exclude_prefixes: tuple[str, ...] = ()
    producer_exclude_prefixes: tuple[str, ...] = ()
    topic_merge: str = "by_cluster"
    # Versions of the state that stay after a cycle; None keeps all.
    keep_versions: int | None = None


@dataclass
class LineageGraph:
    """The edge table and what facets and counts need."""

    inventory: Inventory
    edges: DataFrame
    producers: DataFrame | None
    groups: DataFrame | None
    topic_schemas: DataFrame | None
    schema_facets: DataFrame | None
    topic_metadata: DataFrame | None
    topic_throughput: DataFrame | None


def build_graph(inv: Inventory, opt: Options | None = None) -> LineageGraph:
    opt = opt or Options()
    drafts, bound_producers, bound_groups, throughput = [], None, None, None
    if inv.connectors is not None:
        drafts.append(connect.connector_edges(inv.connectors))
    if inv.ksql_queries is not None:
        drafts.append(ksql.ksql_edges(inv.ksql_queries, inv.ksql_sources))
    if inv.statements is not None:
        drafts.append(statements.flink_edges(inv.statements))
    if inv.metrics is not None:
        metrics = inv.metrics
        if opt.as_of is not None:
            metrics = usage.lookback(metrics, F.lit(opt.as_of).cast("timestamp"), opt.lookback_minutes)
        bound_producers = usage.producers(metrics, opt.producer_exclude_prefixes)
        bound_groups = usage.consumer_groups(metrics, opt.group_exclude_prefixes)
        throughput = usage.topic_throughput(metrics, opt.lookback_minutes)
        drafts += [usage.producer_edges(bound_producers), usage.group_edges(bound_groups)]
    if inv.tableflow_topics is not None:
        drafts.append(tableflow.tableflow_edges(
            inv.tableflow_topics, opt.table_region, opt.table_database))
    all_edges = edges.lineage_edges(drafts, inv.env_dim)

    topic_schemas = facets = None
    if inv.subjects is not None:
        latest = registry.latest_schema_version(inv.subjects)
        topic_schemas = registry.topics_with_schema(edges.graph_topics(all_edges), latest)
        fields = registry.flatten_schemas(latest)
        facets = registry.schema_facets(fields).join(inv.env_dim.select("env_id", "cluster_id"), "env_id")
        facets = facets.select("cluster_id", "topic", "fields_json")
    return LineageGraph(
        inv, all_edges, bound_producers, bound_groups, topic_schemas, facets,
        inv.topic_metadata, throughput,
    )


def summary(graph: LineageGraph) -> DataFrame:
    """The eleven counts of a graph; sources that were not landed count 0. Hand in a graph whose edges are written: they are
    read for the edges, the producers and the groups."""
    spark = graph.edges.sparkSession

    def none(ddl: str) -> DataFrame:
        return spark.createDataFrame([], ddl)

    def rows(df: DataFrame | None, ddl: str) -> DataFrame:
        return none(ddl) if df is None else df

    inv = graph.inventory
    return rollups.graph_summary(
        connectors=rows(inv.connectors, "connect_cluster string"),
        statements=rows(inv.statements, "name string"),
        ksql_queries=rows(inv.ksql_queries, "query_id string"),
        tableflow_topics=rows(inv.tableflow_topics, "topic_name string"),
        edges=graph.edges,
        topic_schemas=rows(graph.topic_schemas, "topic string"),
        topic_metadata=rows(graph.topic_metadata, "topic string"),
        topic_throughput=rows(graph.topic_throughput, "topic string"),
    )


def validate(inv: Inventory, opt: Options | None = None) -> tuple[DataFrame, DataFrame]:
    """Counts and edge listing of what is landed; nothing is emitted and no state is touched."""
    graph = build_graph(inv, opt)
    graph.edges = write_and_reload(graph.edges, "edges")
    return summary(graph), edges.edge_listing(graph.edges)


def documents(
    graph: LineageGraph, jobs: DataFrame, datasets: DataFrame, changes: DataFrame, *,
    cycle: str, event_time: str, opt: Options,
) -> DataFrame:
    """COMPLETE documents of emitted jobs and ABORT documents of removed ones."""
    emitted = changes.where(F.col("action") == diff.EMIT).select(*JOB_KEY)
    rows = datasets.join(emitted, list(JOB_KEY), "left_semi")
    rows = topics.attach_topic_facets(
        rows, graph.inventory.env_dim, graph.schema_facets, graph.topic_metadata,
        graph.topic_throughput, opt.topic_merge,
    )
    complete = events.run_event_documents(
        jobs, write_and_reload(rows, "faceted"), cycle=cycle, event_time=event_time, producer=opt.producer,
    )
    removed = events.abort_documents(
        changes.where(F.col("action") == diff.ABORT), cycle=cycle, event_time=event_time,
        producer=opt.producer,
    )
    removed = removed.withColumn("job", F.struct(
        F.col("job.namespace").alias("namespace"), F.col("job.name").alias("name"),
        F.lit(None).cast(complete.schema["job"].dataType["facets"].dataType).alias("facets"),
    ))
    return complete.unionByName(removed, allowMissingColumns=True)


def run_cycle(
    inv: Inventory, health: DataFrame, *, cycle: str, event_time: str, state_path: str,
    events_path: str, opt: Options | None = None, force: bool | None = None,
    undelivered=None,
) -> DataFrame:
    """Run one cycle and return its one-row statistics.

    `health` has (namespace, ok), and a known namespace without a row, or with a broken document in the landed
    payloads, counts as failed; `force` defaults to true when no state exists yet;
    `undelivered` maps the emitted keys to those whose delivery failed (None: all arrived).
    State is published last, so a failed cycle leaves nothing behind and can be repeated. Tables between the steps
    go when they have been read.
    """
    with scratch_tables():
        stats = _run_cycle(inv, health, cycle, event_time, state_path, events_path, opt or Options(), force, undelivered)
        row = stats.first()
    spark = inv.env_dim.sparkSession
    return spark.range(1).select(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in stats.schema])


def _run_cycle(
    inv: Inventory, health: DataFrame, cycle: str, event_time: str, state_path: str, events_path: str, opt: Options,
    force: bool | None, undelivered,
) -> DataFrame:
    if opt.as_of is None and inv.metrics is not None:
        opt = replace(opt, as_of=event_time)
    spark: SparkSession = inv.env_dim.sparkSession
    graph = build_graph(inv, opt)
    graph.edges = write_and_reload(graph.edges, "edges")
    datasets = write_and_reload(events.event_datasets(graph.edges, opt.fallback_bootstrap), "datasets")
    drop(graph.edges)
    jobs = write_and_reload(events.job_events(datasets, cycle), "jobs", "zstd")
    if force is None:
        force = state_store.published_cycle(spark, state_path, before=cycle) is None
    known = state_store.read_state(spark, state_path, before=cycle)
    expected = known.select(F.col("job_namespace").alias("namespace"))
    if inv.payload_health is not None:
        health = diff.combined_health(health, inv.payload_health)
    failed = diff.failed_namespaces(diff.expected_health(health, expected))
    changes = write_and_reload(diff.diff_cycle(jobs, known, failed, force), "changes", "zstd")
    run_events.write_run_events(
        documents(graph, jobs, datasets, changes, cycle=cycle, event_time=event_time, opt=opt),
        events_path,
    )
    lost = None if undelivered is None else undelivered(changes.where(F.col("action") == diff.EMIT))
    state_store.write_state(diff.next_state(changes, F.lit(event_time), lost), state_path, cycle)
    if opt.keep_versions is not None:
        state_store.prune(spark, state_path, opt.keep_versions)
    return diff.cycle_stats(changes, lost).withColumn("cycle", F.lit(cycle))


def landing_step(
    spark: SparkSession, root: str, env_dim: DataFrame, health_of, *, state_path: str, events_path: str,
    opt: Options | None = None, force: bool | None = None, on_stats=None,
):
    """A step for `streaming.cycles.follow_sources`: the cycle landed in `root/<cycle>`, without what is missing from it.
    `health_of(cycle)` gives (namespace, ok) as the sources report it; `on_stats(cycle, stats)` takes the statistics."""
    def step(cycle: str, event_time: str, missing: frozenset[str]) -> None:
        with scratch_tables():
            inv = read_landing(spark, f"{root}/{cycle}", env_dim, missing=missing)
            stats = run_cycle(
                inv, inventory.without_sources(health_of(cycle), missing), cycle=cycle, event_time=event_time,
                state_path=state_path, events_path=events_path, opt=opt, force=force)
        if on_stats is not None:
            on_stats(cycle, stats)

    return step
