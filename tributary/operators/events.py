"""From edges to one run event per job.

Events live in two tables: `jobs` (one row per job) and `event_datasets` (one row per job, side
and dataset). Documents with nested lists are only built at the sink. A job may own a large
share of all edges, so every step below combines partially before its shuffle, and a document
that would list very many datasets is written in parts that share one run id.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.fixed_values import DATASET_TYPES, TABLE, TOPIC, TOPOLOGY_FACET
from tributary.functions.identity import (
    abort_run_id, job_type_facet, stable_run_id, table_namespace, topic_namespace,
)
from tributary.functions.text import non_empty
from tributary.operators.edges import dataset_endpoints
from tributary.schemas import JOB_KEY, TOPOLOGY_COLUMNS
from tributary.session import write_and_reload

# A dataset hash is added up in chunks of 8 hex digits (32 bits): four of them, each sum exact in
# a bigint for up to two billion datasets of one job.
CHUNK, CHUNKS = 8, 4


def first_seen_dataset(edges: DataFrame, types: tuple[str, ...] = DATASET_TYPES) -> DataFrame:
    """Distinct datasets per job and side; the first edge's declared namespace wins."""
    ends = dataset_endpoints(edges, "edge_seq", types=types)
    return ends.groupBy(*JOB_KEY, "side", "dataset_type", "dataset_name").agg(
        F.min_by("declared_namespace", "edge_seq").alias("declared_namespace"),
        F.min("edge_seq").alias("first_seq"),
    )


def _packed_order() -> Column:
    """The numbers of the edge order as one number: scope, environment, builder, and both positions in 31 bits each.
    Unlike the order itself it has a fixed width, so its least value is found by hash aggregation."""
    seq = F.col("edge_seq")
    place = (seq["scope"].cast("bigint") * (1 << 32) + seq["env_ord"].cast("bigint") + (1 << 31)) * 16 + seq["builder"]
    positions = seq["pos_in"].cast("bigint") * (1 << 31) + seq["pos_out"]
    return place.cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(38,0)") + positions


def job_topology(edges: DataFrame, fallback_bootstrap: str = "") -> DataFrame:
    """Per job: the first non-empty value of each topology field ('' if none) and the bootstrap
    that names all its topics (the fallback if none). Edges of a job that differ in names only have one place in
    the order; of their values the least one counts.

    A job's edges lie in few environments, however many they are: they become one row for each topology, with
    the place of its first edge, before the shuffle. So no edge is sorted, and the lists that fields are picked from
    are as long as a job has topologies."""
    fields = [*TOPOLOGY_COLUMNS, "kafka_bootstrap"]
    places = edges.groupBy(*JOB_KEY, *fields).agg(F.min(_packed_order()).alias("place"))
    lists = places.groupBy(*JOB_KEY).agg(F.collect_list(F.struct("place", *fields)).alias("found"))

    def first(column: str, default: str) -> Column:
        values = F.transform("found", lambda t: F.when(non_empty(t[column]).isNotNull(), F.struct(t["place"].alias("place"), t[column].alias("value"))))
        least = F.array_min(F.filter(values, lambda v: v.isNotNull()))["value"]
        # Nearly all jobs have one topology: nothing to choose from.
        one = F.when(F.size("found") == 1, non_empty(F.get("found", F.lit(0))[column])).otherwise(least)
        return F.coalesce(one, F.lit(default)).alias(column)

    return lists.select(*JOB_KEY, *[first(c, "") for c in TOPOLOGY_COLUMNS], first("kafka_bootstrap", fallback_bootstrap))


def event_datasets(edges: DataFrame, fallback_bootstrap: str = "") -> DataFrame:
    """One row per (job, side, dataset) with the dataset namespace and the job's topology.

    Write the result before grouping it by job again: a join that already clusters rows the way
    the next step wants them is not split when one job is very large."""
    # Topics never declare a namespace, so they need no order, only a hash-based distinct.
    columns = [*JOB_KEY, "side", "dataset_type", "dataset_name", "declared_namespace"]
    found = dataset_endpoints(edges, types=(TOPIC,)).select(*columns).distinct().unionByName(
        first_seen_dataset(edges, types=(TABLE,)).select(*columns))
    # Jobs without a namespace (of no environment) are jobs too.
    topology = job_topology(edges, fallback_bootstrap).withColumnsRenamed({c: f"_{c}" for c in JOB_KEY})
    named = found.join(topology, reduce(and_, [found[c].eqNullSafe(F.col(f"_{c}")) for c in JOB_KEY]))
    namespace = (
        F.when(F.col("dataset_type") == TOPIC, topic_namespace(F.col("kafka_bootstrap")))
        .when(F.col("side") == "input", F.col("job_namespace"))
        .otherwise(table_namespace(F.col("declared_namespace")))
    )
    return named.select(
        *JOB_KEY, "side", "dataset_type", namespace.alias("dataset_namespace"), "dataset_name",
        "kafka_bootstrap", *TOPOLOGY_COLUMNS,
    )


def _dataset_digest() -> Column:
    return F.sha2(F.concat(
        F.col("side"), F.lit(":"), F.concat_ws("/", "dataset_namespace", "dataset_name"),
    ), 256)


def _fingerprint(digest: str) -> Column:
    """Aggregate for rows grouped by job: a hash over the job key and the order-free sums of its
    datasets' hash chunks. Sums combine map-side, so a job with very many datasets never needs
    them in one list. Facets, times and run ids play no part, so a schema or volume change never
    re-emits a job."""
    sums = [
        F.sum(F.conv(F.col(digest).substr(1 + i * CHUNK, CHUNK), 16, 10).cast("bigint")).cast("string")
        for i in range(CHUNKS)
    ]
    return F.sha2(F.concat_ws(",", F.concat_ws("/", "job_namespace", "job_name"), *sums), 256)


def job_events(datasets: DataFrame, cycle: str | Column = "default") -> DataFrame:
    """One COMPLETE event per job: counts, topology, fingerprint and run id. Where a name has jobs of several types, the
    type is part of the run id, so no two jobs share one."""
    cycle = F.lit(cycle) if isinstance(cycle, str) else cycle
    hashed = datasets.select(
        *JOB_KEY, "kafka_bootstrap", *TOPOLOGY_COLUMNS, "side", _dataset_digest().alias("_digest"),
    )
    grouped = hashed.groupBy(*JOB_KEY, "kafka_bootstrap", *TOPOLOGY_COLUMNS).agg(
        F.count_if(F.col("side") == "input").alias("n_inputs"),
        F.count_if(F.col("side") == "output").alias("n_outputs"),
        _fingerprint("_digest").alias("fingerprint"),
    )
    # One row for each type of a name: the window holds as many rows as there are types.
    types = F.count("*").over(Window.partitionBy("job_namespace", "job_name"))
    named = grouped.withColumn("_types", types)
    name = F.when(F.col("_types") > 1, F.concat_ws(":", "job_name", "job_type")).otherwise(F.col("job_name"))
    return named.withColumns({
        "event_type": F.lit("COMPLETE"), "run_id": stable_run_id(F.col("job_namespace"), name, cycle),
    }).drop("_types")


def topology_facet() -> Column:
    """Topology struct, NULL when every field is empty."""
    names = ("envId", "envName", "clusterId", "clusterName", "cloud", "region")
    known = F.concat_ws("", *TOPOLOGY_COLUMNS) != ""
    return F.when(known, F.struct(*[F.col(c).alias(n) for c, n in zip(TOPOLOGY_COLUMNS, names)]))


def _optional(datasets: DataFrame, column: str, build) -> Column:
    if column not in datasets.columns:
        return F.lit(None)
    return F.when(F.col(column).isNotNull(), build(F.col(column)))


def dataset_facets(datasets: DataFrame) -> Column:
    """Facet struct of a dataset row. Synced tables carry none."""
    schema = _optional(datasets, "schema", lambda s: F.when(
        s["fields_json"].isNotNull(), F.struct(F.parse_json(s["fields_json"]).alias("fields"))))
    meta = _optional(datasets, "kafka_topic", lambda m: F.struct(
        m["partitions"].alias("partitions"), m["replication_factor"].alias("replicationFactor"),
        m["is_internal"].alias("isInternal")))
    volume = _optional(datasets, "kafka_throughput", lambda t: F.struct(
        t["bytes_in"].alias("bytesIn"), t["bytes_out"].alias("bytesOut"),
        t["records_in"].alias("recordsIn"), t["records_out"].alias("recordsOut"),
        t["window_minutes"].alias("windowMinutes")))
    facets = {
        TOPOLOGY_FACET: topology_facet(), "schema": schema, "kafkaTopic": meta, "kafkaThroughput": volume,
    }
    # A facet whose map was not joined has no type and is left out.
    columns = {"schema": "schema", "kafkaTopic": "kafka_topic", "kafkaThroughput": "kafka_throughput"}
    present = {n: c for n, c in facets.items() if columns.get(n, "job_name") in datasets.columns}
    any_facet = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in present.values()])
    return F.when(
        (F.col("dataset_type") != TABLE) & any_facet, F.struct(*[c.alias(n) for n, c in present.items()]),
    )


def run_event_documents(
    jobs: DataFrame, datasets: DataFrame, *, cycle: str, event_time: str, producer: str,
    datasets_per_document: int = 10_000, bytes_per_document: int = 16 << 20,
) -> DataFrame:
    """Nested documents. A job's datasets are dealt out by hash to documents of about
    `datasets_per_document` datasets or `bytes_per_document` of schema text; they share one run id, and each
    dataset appears in exactly one. Every document, also a single one, says which it is: `run.part` names
    its share and `run.parts` the number of documents of the run, so a reader knows when a run is whole.
    Lists are sorted by namespace and name; an empty list becomes NULL. `datasets` is read more than
    once, so hand in a written table."""
    key = list(JOB_KEY)
    text = F.length("schema.fields_json") if "schema" in datasets.columns else F.lit(None)
    size = datasets.groupBy(*key).agg(
        F.count("*").alias("_n"), F.sum(F.coalesce(text, F.lit(0)).cast("bigint")).alias("_bytes"),
    )
    wanted = F.greatest(
        F.ceil(F.col("_n") / F.lit(datasets_per_document)),
        F.ceil(F.col("_bytes") / F.lit(bytes_per_document)),
    )
    # Few, as each of them has that many datasets or bytes. Only their rows are dealt out; all others need no count.
    large = write_and_reload(size.select(*key, wanted.alias("_wanted")).where("_wanted > 1"), "large-jobs")
    runs = jobs.select(*key, "run_id")
    if large.isEmpty():
        sized = datasets.join(runs, key).withColumns({"part": F.lit(0), "parts": F.lit(1)})
    else:
        part = F.pmod(F.xxhash64("side", "dataset_namespace", "dataset_name"), F.coalesce("_wanted", F.lit(1))).cast("int")
        dealt = datasets.join(large, key, "left").withColumn("part", part)
        shares = dealt.where("_wanted IS NOT NULL").select(*key, "part").distinct()
        shares = write_and_reload(shares, "shares")
        counted = shares.join(shares.groupBy(*key).agg(F.count("*").cast("int").alias("parts")), key)
        runs = runs.join(counted, key, "left").withColumns({c: F.coalesce(c, F.lit(n)) for c, n in (("part", 0), ("parts", 1))})
        # By part too, so the rows of a large job do not meet in one task.
        sized = dealt.drop("_wanted").join(runs, [*key, "part"])
    entry = F.struct(
        F.col("dataset_namespace").alias("namespace"), F.col("dataset_name").alias("name"),
        dataset_facets(datasets).alias("facets"),
    )

    def ordered(column: str) -> Column:
        found = F.array_sort(column, lambda a, b: (
            F.when(F.struct(a["namespace"], a["name"]) < F.struct(b["namespace"], b["name"]), -1)
            .when(F.struct(a["namespace"], a["name"]) > F.struct(b["namespace"], b["name"]), 1)
            .otherwise(0)
        ))
        # Most lists have one entry: nothing to sort.
        return F.when(F.size(column) > 1, found).when(F.size(column) == 1, F.col(column)).alias(column)

    grouped = sized.groupBy(*key, "run_id", *TOPOLOGY_COLUMNS, "part", "parts").agg(
        F.collect_list(F.when(F.col("side") == "input", entry)).alias("inputs"),
        F.collect_list(F.when(F.col("side") == "output", entry)).alias("outputs"),
    )
    job_facets = F.struct(
        job_type_facet(F.col("job_type")).alias("jobType"), topology_facet().alias(TOPOLOGY_FACET),
    )
    return grouped.select(
        F.lit("COMPLETE").alias("eventType"), F.lit(event_time).alias("eventTime"),
        F.struct(F.col("run_id").alias("runId"), "part", "parts").alias("run"),
        F.struct(
            F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name"),
            job_facets.alias("facets"),
        ).alias("job"),
        ordered("inputs"), ordered("outputs"), F.lit(producer).alias("producer"), F.lit(cycle).alias("cycle"),
    )


def abort_documents(removed: DataFrame, *, cycle: str, event_time: str, producer: str) -> DataFrame:
    """One ABORT document per removed job; the run id is derived, so a retry repeats it."""
    run_id = abort_run_id(F.col("job_namespace"), F.col("job_name"), F.lit(cycle))
    return removed.select(
        F.lit("ABORT").alias("eventType"), F.lit(event_time).alias("eventTime"),
        F.struct(run_id.alias("runId"), F.lit(0).alias("part"), F.lit(1).alias("parts")).alias("run"),
        F.struct(
            F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name"),
        ).alias("job"),
        F.lit(producer).alias("producer"), F.lit(cycle).alias("cycle"),
    )
