"""Row types shared by sources, operators and sinks."""

from pyspark.sql import types as T

from tributary.fixed_values import TOPOLOGY_FACET

S = T.StringType()

CONNECTOR = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("status", S),
    T.StructField("type", S), T.StructField("config", T.MapType(S, S)),
    T.StructField("env_id", S), T.StructField("cluster_id", S),
    T.StructField("connect_cluster", S),
])

# One connector of an inventory document: {name: {info: ..., status: ...}}.
CONNECTOR_DOCUMENT = (
    "map<string, struct<info: struct<type: string, config: map<string,string>>,"
    " status: struct<connector: struct<state: string>>>>"
)

METRIC_ROW = (
    "`timestamp`: string, `metric.topic`: string, `metric.consumer_group_id`: string,"
    " `metric.client_id`: string, value: double"
)

EDGE_SEQ = T.StructType([
    T.StructField("scope", T.IntegerType()), T.StructField("env_ord", T.IntegerType()),
    T.StructField("builder", T.IntegerType()), T.StructField("namespace", S),
    T.StructField("name", S), T.StructField("pos_in", T.IntegerType()),
    T.StructField("pos_out", T.IntegerType()), T.StructField("source", S),
    T.StructField("target", S),
])

TOPOLOGY_COLUMNS = ("env_id", "env_name", "cluster_id", "cluster_name", "cloud", "region")

EDGE_COLUMNS = (
    "source_name", "source_type", "target_name", "target_type",
    "job_name", "job_type", "job_namespace", "target_namespace",
    "kafka_bootstrap", *TOPOLOGY_COLUMNS,
)

JOB_KEY = ("job_namespace", "job_name", "job_type")

STATE = T.StructType([
    T.StructField("job_namespace", S), T.StructField("job_name", S),
    T.StructField("job_type", S), T.StructField("fingerprint", S),
    T.StructField("last_seen_at", S),
])

TOPOLOGY = T.StructType([
    T.StructField(n, S)
    for n in ("envId", "envName", "clusterId", "clusterName", "cloud", "region")
])

DATASET = T.StructType([
    T.StructField("namespace", S), T.StructField("name", S),
    T.StructField("facets", T.StructType([
        T.StructField(TOPOLOGY_FACET, TOPOLOGY),
        T.StructField("schema", T.StructType([T.StructField("fields", T.VariantType())])),
        T.StructField("kafkaTopic", T.StructType([
            T.StructField("partitions", T.IntegerType()),
            T.StructField("replicationFactor", T.IntegerType()),
            T.StructField("isInternal", T.BooleanType()),
        ])),
        T.StructField("kafkaThroughput", T.StructType([
            T.StructField("bytesIn", T.LongType()), T.StructField("bytesOut", T.LongType()),
            T.StructField("recordsIn", T.LongType()), T.StructField("recordsOut", T.LongType()),
            T.StructField("windowMinutes", T.IntegerType()),
        ])),
    ])),
])

RUN_EVENT = T.StructType([
    T.StructField("eventType", S), T.StructField("eventTime", S),
    T.StructField("producer", S),
    T.StructField("run", T.StructType([
        T.StructField("runId", S), T.StructField("part", T.IntegerType()), T.StructField("parts", T.IntegerType()),
    ])),
    T.StructField("job", T.StructType([
        T.StructField("namespace", S), T.StructField("name", S),
        T.StructField("facets", T.StructType([
            T.StructField("jobType", T.StructType([
                T.StructField("processingType", S), T.StructField("integration", S),
                T.StructField("jobType", S),
            ])),
            T.StructField(TOPOLOGY_FACET, TOPOLOGY),
        ])),
    ])),
    T.StructField("inputs", T.ArrayType(DATASET)),
    T.StructField("outputs", T.ArrayType(DATASET)),
])

ORDER = T.StructType([
    T.StructField("ordertime", T.LongType()), T.StructField("orderid", T.IntegerType()),
    T.StructField("itemid", S), T.StructField("orderunits", T.DoubleType()),
    T.StructField("address", T.StructType([
        T.StructField("city", S), T.StructField("state", S),
        T.StructField("zipcode", T.LongType()),
    ])),
])
