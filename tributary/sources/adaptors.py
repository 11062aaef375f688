"""Views that give the driver's tables the shape of landed inventories.

Each view is a table, a filter and a list of expressions in SQL that reads the same in Spark and
in DuckDB, so the oracle queries start from exactly the rows the Spark queries start from.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# view -> (table, filter or None, {column: expression})
VIEWS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "env_dim": ("region", None, {
        "env_id": "'env-' || CAST(r_regionkey AS STRING)",
        "env_name": "r_name",
        "cluster_id": "'lkc-' || CAST(r_regionkey AS STRING)",
        "cluster_name": "'cluster_' || CAST(r_regionkey AS STRING)",
        "env_ord": "CAST(r_regionkey AS INT)",
        "kafka_bootstrap": (
            "CASE WHEN r_regionkey = 4 THEN 'broker.internal:9092'"
            " ELSE 'pkc-' || CAST(r_regionkey AS STRING) || '.zone-' || CAST(r_regionkey AS STRING)"
            " || CASE r_regionkey % 3 WHEN 0 THEN '.aws' WHEN 1 THEN '.gcp' ELSE '.azure' END"
            " || '.confluent.cloud:9092' END"
        ),
    }),
    "deployments": ("supplier", None, {
        "env_id": "'env-' || CAST(s_suppkey AS STRING)",
        "env_name": "s_name",
        "cluster_id": "'lkc-' || CAST(s_suppkey AS STRING)",
        "cluster_name": "'cluster_' || CAST(s_nationkey AS STRING)",
        "env_ord": "CAST(s_suppkey AS INT)",
        "kafka_bootstrap": (
            "CASE s_suppkey % 4 WHEN 0 THEN 'broker-' || CAST(s_suppkey AS STRING) || '.internal:9092'"
            " WHEN 1 THEN '' WHEN 2 THEN 'pkc-' || CAST(s_suppkey AS STRING) || '.zone-'"
            " || CAST(s_nationkey AS STRING) || '.aws.confluent.cloud:9092'"
            " ELSE 'lkc-1.pkc-' || CAST(s_suppkey AS STRING) || '.zone-' || CAST(s_nationkey AS STRING)"
            " || '.gcp.confluent.cloud' END"
        ),
        "nationkey": "s_nationkey",
    }),
    "metric_rows": ("events", None, {
        "event_id": "event_id",
        "ts": "ts",
        "cluster_id": "'lkc-' || CAST(user_id % 5 AS STRING)",
        "metric": (
            "CASE event_id % 5 WHEN 0 THEN 'consumer_lag_offsets' WHEN 1 THEN 'received_bytes'"
            " WHEN 2 THEN 'sent_bytes' WHEN 3 THEN 'received_records' ELSE 'sent_records' END"
        ),
        "topic": (
            "CASE WHEN event_id % 97 = 0 THEN ''"
            " ELSE 'topic-' || CAST((user_id * 7 + event_id % 3) % 200 AS STRING) END"
        ),
        "consumer_group_id": (
            "CASE user_id % 10 WHEN 0 THEN '_confluent-' WHEN 1 THEN 'confluent_cli_consumer_'"
            " ELSE 'app-' END || CAST(user_id AS STRING)"
        ),
        "client_id": (
            "CASE user_id % 10 WHEN 2 THEN 'connector-producer-' WHEN 3 THEN 'connector-'"
            " WHEN 4 THEN '_confluent-flink_' ELSE 'svc-' END || CAST(user_id AS STRING)"
        ),
        "value": "value",
    }),
    "connectors_json": ("supplier", None, {
        "name": "'conn-' || CAST(s_suppkey AS STRING)",
        "env_id": "'env-' || CAST(s_nationkey % 5 AS STRING)",
        "type": "CASE s_suppkey % 2 WHEN 0 THEN 'source' ELSE 'sink' END",
        "status": "CASE s_suppkey % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'PAUSED' ELSE 'UNASSIGNED' END",
        "connect_cluster": (
            "CASE WHEN s_suppkey % 10 = 9 THEN 'on-prem-' || CAST(s_suppkey % 3 AS STRING) END"
        ),
        "config_json": (
            "CASE s_suppkey % 4"
            " WHEN 0 THEN '{\"kafka.topic\":\"topic-' || CAST(s_suppkey % 200 AS STRING) || '\"}'"
            " WHEN 1 THEN '{\"topics\":\"topic-' || CAST(s_suppkey % 200 AS STRING) || ', topic-'"
            " || CAST((s_suppkey + 1) % 200 AS STRING) || ',, \"}'"
            " WHEN 2 THEN '{\"kafka.topic\":\"\",\"topic\":\"topic-' || CAST(s_suppkey % 200 AS STRING) || '\"}'"
            " ELSE '{\"kafka.topics\":\"topic-' || CAST(s_suppkey % 200 AS STRING) || '\"}' END"
        ),
    }),
    "flink_statements": ("orders", None, {
        "name": "'stmt-' || CAST(o_orderkey AS STRING)",
        "env_id": "'env-' || CAST(o_custkey % 5 AS STRING)",
        "status": "CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'stopped' ELSE 'FAILED' END",
        "sql_text": (
            "CASE o_orderkey % 5"
            " WHEN 0 THEN 'INSERT INTO `topic-' || CAST((o_custkey * 7 + 3) % 200 AS STRING)"
            " || '` SELECT * FROM `topic-' || CAST(o_custkey % 200 AS STRING) || '` WHERE v > 1;'"
            " WHEN 1 THEN '-- FROM ghost' || chr(10) || 'INSERT INTO `topic-'"
            " || CAST((o_custkey * 7 + 3) % 200 AS STRING) || '` SELECT a.id /* JOIN' || chr(10)"
            " || ' ghost2 */ FROM `topic-' || CAST(o_custkey % 200 AS STRING)"
            " || '` a JOIN topic_plain b ON a.id = b.id'"
            " WHEN 2 THEN 'INSERT INTO `topic-' || CAST(o_custkey % 200 AS STRING)"
            " || '` SELECT * FROM `topic-' || CAST(o_custkey % 200 AS STRING) || '`'"
            " WHEN 3 THEN 'create table if not exists `topic-' || CAST((o_custkey * 3 + 1) % 200 AS STRING)"
            " || '` as select * from `topic-' || CAST(o_custkey % 200 AS STRING)"
            " || '` join `topic-' || CAST((o_custkey + 11) % 200 AS STRING) || '` on 1 = 1'"
            " ELSE 'SELECT 1 FROM `topic-' || CAST(o_custkey % 200 AS STRING) || '`' END"
        ),
    }),
    "ksql_descriptions": ("customer", None, {
        "name": "'Stream_' || CAST(c_custkey AS STRING)",
        "topic": "'topic-' || CAST(c_custkey * 8 % 200 AS STRING)",
        "ksql_cluster_id": "'lksqlc-' || CAST(c_nationkey % 5 AS STRING)",
        "custkey": "c_custkey",
    }),
    "ksql_queries_flat": ("customer", None, {
        "query_id": "'CSAS_' || CAST(c_custkey AS STRING)",
        "ksql_cluster_id": "'lksqlc-' || CAST(c_nationkey % 5 AS STRING)",
        "state": "CASE c_custkey % 4 WHEN 0 THEN 'PAUSED' WHEN 1 THEN 'running' ELSE 'RUNNING' END",
        "source_name": "'STREAM_' || CAST(c_custkey % 40 AS STRING)",
        "sink_topic": "'topic-' || CAST(c_custkey % 200 AS STRING)",
    }),
    "tableflow_topics": ("part", None, {
        "env_id": "'env-' || CAST(p_size % 5 AS STRING)",
        "topic_name": "'topic-' || CAST(p_partkey AS STRING)",
        "status": (
            "CASE p_size % 4 WHEN 0 THEN 'DISABLED' WHEN 1 THEN 'deleted' WHEN 2 THEN 'RUNNING'"
            " ELSE 'SUSPENDED' END"
        ),
    }),
    "topic_metadata": ("part", None, {
        "cluster_id": "'lkc-' || CAST(p_partkey % 5 AS STRING)",
        "topic": "'topic-' || CAST(p_partkey AS STRING)",
        "partitions": "CAST(p_size AS INT)",
        "replication_factor": "3",
        "is_internal": "p_size % 7 = 0",
    }),
    "schema_subjects_raw": ("part", None, {
        "env_id": "'env-' || CAST(p_partkey % 5 AS STRING)",
        "subject": (
            "'topic-' || CAST(p_partkey % 200 AS STRING)"
            " || CASE p_partkey % 2 WHEN 0 THEN '-value' ELSE '-key' END"
        ),
        "version": "CAST(floor(p_partkey / 200) AS INT)",
        "partkey": "p_partkey",
        "raw_type": (
            "CASE p_partkey % 5 WHEN 0 THEN 'JSON' WHEN 1 THEN 'PROTOBUF' WHEN 2 THEN NULL ELSE 'AVRO' END"
        ),
        "schema_text": (
            "CASE p_partkey % 5 WHEN 0 THEN '{\"type\":\"object\",\"properties\":{\"id\":{\"type\":\"string\"},"
            "\"amt\":{\"type\":[\"null\",\"number\"]},\"tags\":{\"type\":\"array\",\"items\":{\"type\":\"object\","
            "\"properties\":{\"k\":{\"type\":\"string\"}}}}}}'"
            " WHEN 1 THEN 'syntax = \"proto3\"; message M { string id = 1; }'"
            " ELSE '{\"type\":\"record\",\"name\":\"R' || CAST(p_partkey AS STRING) || '\",\"fields\":["
            "{\"name\":\"id\",\"type\":\"long\",\"doc\":\"pk\"},"
            "{\"name\":\"c\",\"type\":[\"null\",{\"type\":\"record\",\"name\":\"C\",\"fields\":"
            "[{\"name\":\"e\",\"type\":[\"null\",\"string\"]}]}]},"
            "{\"name\":\"xs\",\"type\":{\"type\":\"array\",\"items\":{\"type\":\"map\",\"values\":\"double\"}}},"
            "{\"name\":\"d\",\"type\":{\"type\":\"bytes\",\"logicalType\":\"decimal\"}},"
            "{\"name\":\"u\",\"type\":[\"null\",\"string\",\"int\"]}]}' END"
        ),
    }),
    "order_records": ("orders", None, {
        "orderkey": "o_orderkey",
        "custkey": "o_custkey",
        "status": "o_orderstatus",
        "ordertime": "CAST(year(o_orderdate) AS BIGINT) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)",
        "orderid": "CAST(o_orderkey AS INT)",
        "itemid": "'Item_' || CAST(o_custkey % 500 AS STRING)",
        "orderunits": "CAST(o_totalprice % 20 AS DOUBLE)",
        "city": "'City_' || CAST(o_custkey % 97 AS STRING)",
        "state": "'State_' || CAST(o_custkey % 25 AS STRING)",
        "zipcode": "CAST(10000 + o_custkey % 90000 AS BIGINT)",
    }),
}

# Views with a grouping step, as DuckDB text; the Spark form is in `Landed`.
JOB_CYCLES_SQL = (
    "SELECT CAST(year(o_orderdate) AS INT) AS cycle, 'ns-' || CAST(o_custkey % 7 AS STRING) AS namespace,"
    " 'job-' || CAST(o_custkey AS STRING) AS name, 'topic-' || CAST(o_custkey % 200 AS STRING) AS input_topic,"
    " 'topic-' || CAST(max(o_orderkey) % 3 AS STRING) AS output_topic"
    " FROM orders GROUP BY o_custkey, year(o_orderdate)"
)
SOURCE_HEALTH_SQL = (
    "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS cycle, 'ns-' || CAST(o_custkey % 7 AS STRING) AS namespace,"
    " (year(o_orderdate) + o_custkey % 7) % 4 <> 0 AS ok FROM orders"
)


def view_sql(name: str) -> str:
    """The view as a DuckDB query."""
    table, where, columns = VIEWS[name]
    body = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT {body} FROM {table}" + (f" WHERE {where}" if where else "")


# Schemas already read from a file footer; a schema given up front saves a job per read.
_SCHEMAS: dict[str, StructType] = {}


class Landed:
    """The views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def view(self, name: str) -> DataFrame:
        table, where, columns = VIEWS[name]
        df = self.table(table)
        return (df.where(where) if where else df).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])

    def env_dim(self) -> DataFrame:
        return self.view("env_dim")

    def metric_rows(self) -> DataFrame:
        return self.view("metric_rows").withColumn("ts", F.col("ts").cast("timestamp"))

    def connectors(self) -> DataFrame:
        return self.view("connectors_json").select(
            F.concat_ws(":", F.coalesce("connect_cluster", "env_id"), "name").alias("id"),
            "name", "status", "type",
            F.from_json("config_json", "map<string,string>").alias("config"),
            "env_id", F.lit(None).cast("string").alias("cluster_id"), "connect_cluster",
        )

    def flink_statements(self) -> DataFrame:
        return self.view("flink_statements")

    def ksql_sources(self) -> DataFrame:
        return self.view("ksql_descriptions").select(
            "ksql_cluster_id", F.upper("name").alias("name"), "topic",
        )

    def ksql_queries(self) -> DataFrame:
        return self.view("ksql_queries_flat").select(
            "query_id", "ksql_cluster_id", "state", F.array("sink_topic").alias("sink_topics"),
            F.array("source_name").alias("sources"),
        )

    def tableflow_topics(self) -> DataFrame:
        return self.view("tableflow_topics")

    def topic_metadata(self) -> DataFrame:
        return self.view("topic_metadata")

    def schema_subjects(self) -> DataFrame:
        raw = self.view("schema_subjects_raw")
        return raw.select(
            "env_id", "subject", "version",
            F.upper(F.coalesce("raw_type", F.lit("AVRO"))).alias("schema_type"), "schema_text",
        )

    def orders(self) -> DataFrame:
        return self.view("order_records").select(
            "ordertime", "orderid", "itemid", "orderunits",
            F.struct("city", "state", "zipcode").alias("address"),
        )

    def job_cycles(self) -> DataFrame:
        per_year = (
            self.table("orders")
            .groupBy("o_custkey", F.year("o_orderdate").alias("cycle"))
            .agg(F.max("o_orderkey").alias("last_key"))
        )
        return per_year.selectExpr(
            "cycle", "'ns-' || CAST(o_custkey % 7 AS STRING) AS namespace",
            "'job-' || CAST(o_custkey AS STRING) AS name",
            "'topic-' || CAST(o_custkey % 200 AS STRING) AS input_topic",
            "'topic-' || CAST(last_key % 3 AS STRING) AS output_topic",
        )

    def job_history(self) -> DataFrame:
        return self.job_cycles().select(
            "cycle", "namespace", "name", F.concat("input_topic", F.lit(">"), "output_topic").alias("fp"),
        )

    def source_health(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "CAST(year(o_orderdate) AS INT) AS cycle",
            "'ns-' || CAST(o_custkey % 7 AS STRING) AS namespace",
            "(year(o_orderdate) + o_custkey % 7) % 4 <> 0 AS ok",
        ).distinct()
