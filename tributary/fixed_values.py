"""Values that results depend on. They are data, not logic: keep them as they are."""

# Statement states whose lineage is kept (compared in upper case).
ACTIVE_STATEMENT_STATES = ("RUNNING", "STOPPED")
ACTIVE_PERSISTENT_QUERY_STATES = ("RUNNING",)
INACTIVE_TABLE_SYNC_STATES = ("DISABLED", "DELETED")

# Words that can follow FROM / JOIN without being a table name.
SQL_STOP_WORDS = (
    "SELECT", "WHERE", "ON", "AND", "OR", "NOT", "NULL", "AS", "CASE",
    "WHEN", "THEN", "ELSE", "END", "GROUP", "ORDER", "BY", "HAVING",
    "LIMIT", "OFFSET", "INNER", "LEFT", "RIGHT", "OUTER", "CROSS",
    "LATERAL", "TABLESAMPLE", "UNNEST",
)

# Id prefixes of platform-internal clients; they are covered by other sources.
INTERNAL_GROUP_PREFIXES = ("_", "confluent_cli_consumer_")
INTERNAL_PRODUCER_PREFIXES = ("connector-producer-", "connector-", "_confluent-flink_")

# Metric names.
LAG_METRIC = "consumer_lag_offsets"
RECEIVED_BYTES = "received_bytes"
SENT_BYTES = "sent_bytes"
RECEIVED_RECORDS = "received_records"
SENT_RECORDS = "sent_records"
THROUGHPUT_COLUMNS = {
    RECEIVED_BYTES: "bytes_in",
    SENT_BYTES: "bytes_out",
    RECEIVED_RECORDS: "records_in",
    SENT_RECORDS: "records_out",
}
DEFAULT_LOOKBACK_MINUTES = 10

# job_type -> (processing type, integration, job type) of the job-type facet.
JOB_TYPE_FACETS = {
    "kafka_connect_source": ("STREAMING", "KAFKA_CONNECT", "SOURCE_CONNECTOR"),
    "kafka_connect_sink": ("STREAMING", "KAFKA_CONNECT", "SINK_CONNECTOR"),
    "flink_statement": ("STREAMING", "FLINK", "QUERY"),
    "kafka_producer": ("STREAMING", "KAFKA", "PRODUCER"),
    "kafka_consumer_group": ("STREAMING", "KAFKA", "CONSUMER_GROUP"),
    "ksqldb_query": ("STREAMING", "KSQLDB", "QUERY"),
    "tableflow": ("BATCH", "TABLEFLOW", "TABLE_SYNC"),
}
DEFAULT_JOB_TYPE_FACET = ("STREAMING", "KAFKA")

# Key of the topology facet in documents.
TOPOLOGY_FACET = "confluent"

# Endpoint types that become datasets.
TOPIC = "kafka_topic"
TABLE = "iceberg_table"
EXTERNAL = "external"
GROUP = "consumer_group"
DATASET_TYPES = (TOPIC, TABLE)

DEFAULT_TABLE_NAMESPACE = "iceberg://tableflow"
MANAGED_HOST_SUFFIX = ("confluent", "cloud")
DEFAULT_SCHEMA_TYPE = "AVRO"
PROTOBUF_DESCRIPTION_CHARS = 500

# Kinds of provisioned resources that can be reconciled.
RESOURCE_KINDS = ("topic", "connector", "statement")

# Lower bounds (exclusive) of the order risk tiers.
RISK_HIGH_ABOVE = 10
RISK_MEDIUM_ABOVE = 5
