"""DuckDB counterparts of the registered queries.

Queries are written over named building blocks. `ORACLES` holds complete texts: each query with
the blocks it mentions, and the blocks those mention, in a leading WITH.
"""

from __future__ import annotations

import re

from tributary.fixed_values import SQL_STOP_WORDS
from tributary.sources.adaptors import JOB_CYCLES_SQL, SOURCE_HEALTH_SQL, VIEWS, view_sql

EVENT_TIME = "2024-02-01T00:00:00Z"
CYCLE = "20240201T000000"
STOP = ", ".join(f"'{w}'" for w in SQL_STOP_WORDS)
ID = r"(`[^`]+`|[A-Za-z_][A-Za-z0-9_\-]*)"
TOPO = "env_id, env_name, cluster_id, cluster_name, cloud, region"
JOB = "job_namespace, job_name, job_type"
SEQ = "scope, env_ord, builder, job_namespace, job_name, pos_in, pos_out, source_name, target_name"

BLOCKS: dict[str, str] = {name: view_sql(name) for name in VIEWS}
BLOCKS |= {
    "job_cycles": JOB_CYCLES_SQL,
    "source_health": SOURCE_HEALTH_SQL,
    "connectors": "SELECT *, config_json AS config FROM connectors_json",
    # first non-empty setting, split on commas, stripped, empties dropped
    "conn_lists": """
        SELECT name, type, env_id, connect_cluster,
          list_filter(list_transform(string_split(coalesce(
            CASE type WHEN 'source' THEN coalesce(
              nullif(json_extract_string(config, '$."kafka.topic"'), ''), nullif(json_extract_string(config, '$.topic'), ''))
            WHEN 'sink' THEN coalesce(
              nullif(json_extract_string(config, '$.topics'), ''), nullif(json_extract_string(config, '$."kafka.topics"'), ''),
              nullif(json_extract_string(config, '$.topic'), '')) END, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS topics
        FROM connectors""",
    "conn_topics": """
        SELECT name, type, env_id, connect_cluster, CAST(i AS INT) AS pos, topics[i + 1] AS topic
        FROM (SELECT *, unnest(range(len(topics))) AS i FROM conn_lists)""",
    "conn_edges": """
        SELECT CASE type WHEN 'source' THEN name ELSE topic END AS source_name,
          CASE type WHEN 'source' THEN 'external' ELSE 'kafka_topic' END AS source_type,
          CASE type WHEN 'source' THEN topic ELSE name END AS target_name,
          CASE type WHEN 'source' THEN 'kafka_topic' ELSE 'external' END AS target_type,
          name AS job_name, 'kafka_connect_' || type AS job_type,
          'kafka-connect://' || coalesce(connect_cluster, env_id) AS job_namespace,
          CAST(NULL AS VARCHAR) AS target_namespace,
          CASE WHEN connect_cluster IS NULL THEN env_id END AS scope_key, 1 AS builder, pos AS pos_in, 0 AS pos_out
        FROM conn_topics""",
    "stmt_clean": r"""
        SELECT name, env_id, status,
          regexp_replace(regexp_replace(sql_text, '--[^\n]*', ' ', 'g'), '/\*.*?\*/', ' ', 'gs') AS s
        FROM flink_statements""",
    "stmt_names": rf"""
        SELECT name, env_id, status,
          list_transform(regexp_extract_all(s, '(?i)(?:INSERT\s+INTO|CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?)\s*{ID}', 1),
            lambda x: replace(x, '`', '')) AS outputs,
          list_filter(list_transform(list_concat(
            regexp_extract_all(s, '(?i)(?:^|\W)FROM\s+{ID}', 1), regexp_extract_all(s, '(?i)(?:^|\W)JOIN\s+{ID}', 1)),
            lambda x: replace(x, '`', '')), lambda x: upper(x) NOT IN ({STOP})) AS read
        FROM stmt_clean""",
    "stmt_refs": """
        SELECT name, env_id, status, outputs, list_filter(read, lambda x: NOT list_contains(outputs, x)) AS inputs
        FROM stmt_names""",
    "stmt_in": "SELECT *, unnest(range(len(inputs))) AS i FROM stmt_refs",
    "stmt_pairs": """
        SELECT name, env_id, status, CAST(i AS INT) AS pos_in, inputs[i + 1] AS input,
          CAST(o AS INT) AS pos_out, outputs[o + 1] AS output
        FROM (SELECT *, unnest(range(len(outputs))) AS o FROM stmt_in)""",
    "flink_edges": """
        SELECT input AS source_name, 'kafka_topic' AS source_type, output AS target_name, 'kafka_topic' AS target_type,
          name AS job_name, 'flink_statement' AS job_type, 'flink://' || env_id AS job_namespace,
          CAST(NULL AS VARCHAR) AS target_namespace, env_id AS scope_key, 2 AS builder, pos_in, pos_out
        FROM stmt_pairs WHERE upper(status) IN ('RUNNING', 'STOPPED')""",
    "groups": """
        SELECT DISTINCT cluster_id, consumer_group_id, topic FROM metric_rows
        WHERE metric = 'consumer_lag_offsets' AND consumer_group_id <> '' AND topic <> ''
          AND left(consumer_group_id, 1) <> '_' AND consumer_group_id NOT LIKE 'confluent\\_cli\\_consumer\\_%' ESCAPE '\\'
        """.replace("\\\\", "\\"),
    "writers": """
        SELECT DISTINCT cluster_id, client_id, topic FROM metric_rows
        WHERE metric = 'received_bytes' AND client_id <> '' AND topic <> ''
          AND client_id NOT LIKE 'connector-%' AND NOT starts_with(client_id, '_confluent-flink_')""",
    "producer_edges": """
        SELECT client_id AS source_name, 'external' AS source_type, topic AS target_name, 'kafka_topic' AS target_type,
          client_id AS job_name, 'kafka_producer' AS job_type, 'kafka-producer://' || cluster_id AS job_namespace,
          CAST(NULL AS VARCHAR) AS target_namespace, cluster_id AS scope_key, 3 AS builder, 0 AS pos_in, 0 AS pos_out
        FROM writers""",
    "group_edges": """
        SELECT topic AS source_name, 'kafka_topic' AS source_type, consumer_group_id AS target_name,
          'consumer_group' AS target_type, consumer_group_id AS job_name, 'kafka_consumer_group' AS job_type,
          'kafka-consumer-group://' || cluster_id AS job_namespace, CAST(NULL AS VARCHAR) AS target_namespace,
          cluster_id AS scope_key, 4 AS builder, 0 AS pos_in, 0 AS pos_out
        FROM groups""",
    "tableflow_edges": """
        SELECT topic_name AS source_name, 'kafka_topic' AS source_type, replace(topic_name, '-', '_') AS target_name,
          'iceberg_table' AS target_type, topic_name AS job_name, 'tableflow' AS job_type,
          'tableflow://' || env_id AS job_namespace, 'iceberg://tableflow' AS target_namespace,
          env_id AS scope_key, 5 AS builder, 0 AS pos_in, 0 AS pos_out
        FROM tableflow_topics WHERE upper(status) NOT IN ('DISABLED', 'DELETED')""",
    "ksql_resolved": """
        SELECT q.query_id, q.ksql_cluster_id, q.state, q.sink_topic, q.source_name AS source,
          coalesce(d.topic, q.source_name) AS source_topic
        FROM ksql_queries_flat q LEFT JOIN ksql_descriptions d
          ON d.ksql_cluster_id = q.ksql_cluster_id AND upper(d.name) = upper(q.source_name)""",
    "ksql_edges": """
        SELECT source_topic AS source_name, 'kafka_topic' AS source_type, sink_topic AS target_name,
          'kafka_topic' AS target_type, query_id AS job_name, 'ksqldb_query' AS job_type,
          'ksqldb://' || ksql_cluster_id AS job_namespace, CAST(NULL AS VARCHAR) AS target_namespace,
          CAST(NULL AS VARCHAR) AS scope_key, 2 AS builder, 0 AS pos_in, 0 AS pos_out
        FROM ksql_resolved WHERE upper(state) = 'RUNNING' AND source_topic <> sink_topic""",
    "env_topo": """
        SELECT *, CASE WHEN managed THEN parts[-3] ELSE '' END AS cloud, CASE WHEN managed THEN parts[-4] ELSE '' END AS region
        FROM (SELECT *, len(parts) >= 5 AND parts[-2] = 'confluent' AND parts[-1] = 'cloud' AS managed
              FROM (SELECT *, string_split(split_part(kafka_bootstrap, ':', 1), '.') AS parts FROM env_dim))""",
    "drafts": """
        SELECT * FROM conn_edges UNION ALL SELECT * FROM flink_edges UNION ALL SELECT * FROM producer_edges
        UNION ALL SELECT * FROM group_edges UNION ALL SELECT * FROM tableflow_edges UNION ALL SELECT * FROM ksql_edges""",
    "edges": f"""
        SELECT d.*, t.kafka_bootstrap, t.env_id, t.env_name, t.cluster_id, t.cluster_name, t.cloud, t.region,
          CASE WHEN d.scope_key IS NULL THEN 0 ELSE 1 END AS scope, coalesce(t.env_ord, 0) AS env_ord
        FROM drafts d LEFT JOIN env_topo t ON d.scope_key = t.env_id OR d.scope_key = t.cluster_id""",
    "ends": f"""
        SELECT {JOB}, 'input' AS side, source_type AS dataset_type, source_name AS dataset_name,
          CAST(NULL AS VARCHAR) AS declared_namespace, source_name, target_name, scope, env_ord, builder, pos_in, pos_out FROM edges
        UNION ALL
        SELECT {JOB}, 'output', target_type, target_name, target_namespace, source_name, target_name,
          scope, env_ord, builder, pos_in, pos_out FROM edges""",
    "kept_ends": "SELECT * FROM ends WHERE dataset_type IN ('kafka_topic', 'iceberg_table')",
    "first_seen": f"""
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY {JOB}, side, dataset_type, dataset_name ORDER BY {SEQ}) AS rn FROM kept_ends) WHERE rn = 1""",
    "job_topo": f"""
        SELECT {JOB}, """ + ", ".join(
            f"coalesce(first({c} ORDER BY {SEQ}) FILTER (WHERE {c} <> ''), '') AS {c}"
            for c in TOPO.split(", ")) + f""",
          coalesce(first(kafka_bootstrap ORDER BY {SEQ}) FILTER (WHERE kafka_bootstrap <> ''), 'fallback:9092') AS kafka_bootstrap
        FROM edges GROUP BY {JOB}""",
    "event_datasets": f"""
        SELECT f.job_namespace, f.job_name, f.job_type, f.side, f.dataset_type,
          CASE WHEN f.dataset_type = 'kafka_topic' THEN 'kafka://' || j.kafka_bootstrap
               WHEN f.side = 'input' THEN f.job_namespace
               ELSE coalesce(nullif(f.declared_namespace, ''), 'iceberg://tableflow') END AS dataset_namespace,
          f.dataset_name, j.kafka_bootstrap, j.env_id, j.env_name, j.cluster_id, j.cluster_name, j.cloud, j.region
        FROM first_seen f JOIN job_topo j USING ({JOB})""",
    "hashed": """
        SELECT *, sha256(side || ':' || dataset_namespace || '/' || dataset_name) AS h FROM event_datasets""",
    "job_sums": f"""
        SELECT {JOB}, {TOPO}, kafka_bootstrap,
          count(*) FILTER (WHERE side = 'input') AS n_inputs, count(*) FILTER (WHERE side = 'output') AS n_outputs, """
        + ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT)::VARCHAR AS s{i}" for i in range(4)) + f"""
        FROM hashed GROUP BY {JOB}, {TOPO}, kafka_bootstrap""",
    "jobs": """
        SELECT *, sha256(concat_ws(',', job_namespace || '/' || job_name, s0, s1, s2, s3)) AS fingerprint,
          sha256(job_namespace || ':' || job_name || ':' || '%s') AS rh FROM job_sums""" % CYCLE,
    "throughput": """
        SELECT cluster_id, topic, """ + ", ".join(
            f"coalesce(sum(trunc(value)::BIGINT) FILTER (WHERE metric = '{m}'), 0)::BIGINT AS {c}"
            for m, c in (("received_bytes", "bytes_in"), ("sent_bytes", "bytes_out"),
                         ("received_records", "records_in"), ("sent_records", "records_out"))) + """,
          10 AS window_minutes
        FROM metric_rows WHERE metric <> 'consumer_lag_offsets' AND topic <> '' AND value IS NOT NULL
        GROUP BY cluster_id, topic""",
    "ranked_throughput": """
        SELECT t.*, row_number() OVER (PARTITION BY t.topic ORDER BY e.env_ord DESC, t.cluster_id DESC) AS rn
        FROM throughput t JOIN env_dim e USING (cluster_id)""",
    "merged_throughput": "SELECT * FROM ranked_throughput WHERE rn = 1",
    "merged_metadata": """
        SELECT * FROM (SELECT m.*, row_number() OVER (PARTITION BY m.topic ORDER BY e.env_ord DESC) AS rn
          FROM topic_metadata m JOIN env_dim e USING (cluster_id)) WHERE rn = 1""",
    "any_throughput": """
        SELECT cluster_id AS lookup, topic, bytes_in, records_out FROM throughput
        UNION ALL SELECT '', topic, bytes_in, records_out FROM merged_throughput""",
    "any_metadata": """
        SELECT cluster_id AS lookup, topic, partitions, is_internal FROM topic_metadata
        UNION ALL SELECT '', topic, partitions, is_internal FROM merged_metadata""",
    "subjects": """
        SELECT env_id, subject, version, upper(coalesce(raw_type, 'AVRO')) AS schema_type, schema_text, partkey
        FROM schema_subjects_raw""",
    "latest": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY env_id, subject ORDER BY version DESC) AS rn FROM subjects)
        WHERE rn = 1""",
    "graph_topics": """
        SELECT DISTINCT env_id, cluster_id, topic FROM (
          SELECT env_id, cluster_id, source_name AS topic FROM edges WHERE source_type = 'kafka_topic'
          UNION ALL SELECT env_id, cluster_id, target_name FROM edges WHERE target_type = 'kafka_topic')""",
    "topic_schemas": """
        SELECT * FROM (SELECT g.env_id, g.cluster_id, g.topic, k.subject AS key_subject, k.schema_type AS key_schema_type,
            v.subject AS value_subject, v.schema_type AS value_schema_type
          FROM graph_topics g
          LEFT JOIN latest k ON k.env_id = g.env_id AND k.subject = g.topic || '-key'
          LEFT JOIN latest v ON v.env_id = g.env_id AND v.subject = g.topic || '-value')
        WHERE key_subject IS NOT NULL OR value_subject IS NOT NULL""",
    "any_schema": """
        SELECT cluster_id AS lookup, topic, concat_ws(',', key_subject, value_subject) AS subjects FROM topic_schemas
        UNION ALL SELECT '', topic, subjects FROM (
          SELECT s.topic, concat_ws(',', s.key_subject, s.value_subject) AS subjects,
            row_number() OVER (PARTITION BY s.topic ORDER BY e.env_ord DESC) AS rn
          FROM topic_schemas s JOIN env_dim e USING (cluster_id)) WHERE rn = 1""",
    # fields every schema text of the view has, by kind
    "avro_shape": """
        SELECT * FROM (VALUES ('id', 1, 0, 'id', 'long', 'pk'), ('c', 1, 1, 'c', 'record<C>', NULL),
          ('c.e', 2, 0, 'e', 'string', NULL), ('xs', 1, 2, 'xs', 'array<map<string,double>>', NULL),
          ('d', 1, 3, 'd', 'bytes(decimal)', NULL), ('u', 1, 4, 'u', 'union<null | string | int>', NULL))
          AS s(field, depth, pos, name, type, description)""",
    "json_shape": """
        SELECT * FROM (VALUES ('id', 1, 0, 'id', 'string'), ('amt', 1, 1, 'amt', 'null | number'),
          ('tags', 1, 2, 'tags', 'array<object>'), ('tags.k', 2, 0, 'k', 'string')) AS s(field, depth, pos, name, type)""",
    "fields": """
        SELECT env_id, subject, version, schema_type, field, depth, pos, name, type, description FROM subjects, avro_shape
        WHERE schema_type = 'AVRO'
        UNION ALL SELECT env_id, subject, version, schema_type, field, depth, pos, name, type, NULL FROM subjects, json_shape
        WHERE schema_type = 'JSON'
        UNION ALL SELECT env_id, subject, version, schema_type, '<protobuf>', 1, 0, '<protobuf>', 'protobuf', left(schema_text, 500)
        FROM subjects WHERE schema_type = 'PROTOBUF'""",
    "part_fields": "SELECT s.partkey, f.field, f.type FROM fields f JOIN subjects s USING (env_id, subject, version)",
    "history": "SELECT cycle, namespace, name, input_topic || '>' || output_topic AS fp FROM job_cycles",
    "first_cycle": "SELECT namespace, name, min(cycle) AS c0 FROM history GROUP BY namespace, name",
    "grid": """
        SELECT j.namespace, j.name, h.cycle, h.ok, c.fp FROM first_cycle j
        JOIN source_health h ON h.namespace = j.namespace AND h.cycle >= j.c0
        LEFT JOIN history c ON c.namespace = j.namespace AND c.name = j.name AND c.cycle = h.cycle""",
    "observed": "SELECT *, CASE WHEN fp IS NOT NULL OR ok THEN coalesce(fp, '') END AS seen FROM grid",
    "carried": """
        SELECT *, last_value(seen IGNORE NULLS) OVER (PARTITION BY namespace, name ORDER BY cycle
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM observed""",
    "actions": """
        SELECT cycle, namespace, name, CASE WHEN fp IS NOT NULL THEN CASE WHEN fp = prev THEN 'SKIP' ELSE 'EMIT' END
          WHEN ok THEN 'ABORT' ELSE 'QUARANTINED' END AS action
        FROM carried WHERE fp IS NOT NULL OR (prev IS NOT NULL AND prev <> '')""",
    "numbered_documents": r"""
        SELECT 'connect' AS kind, 'kafka-connect://' || coalesce(connect_cluster, env_id) AS namespace, name AS label FROM connectors
        UNION ALL SELECT 'flink', 'flink://' || env_id, name FROM flink_statements
        UNION ALL SELECT 'metrics', CASE metric WHEN 'received_bytes' THEN 'kafka-producer://' || cluster_id
          WHEN 'consumer_lag_offsets' THEN 'kafka-consumer-group://' || cluster_id ELSE 'none://' || cluster_id END, client_id FROM metric_rows
        UNION ALL SELECT 'ksql_queries', 'ksqldb://' || ksql_cluster_id, query_id FROM ksql_queries_flat
        UNION ALL SELECT 'ksql_sources', 'ksqldb://' || ksql_cluster_id, name FROM ksql_descriptions
        UNION ALL SELECT 'tableflow', 'tableflow://' || env_id, topic_name FROM tableflow_topics""",
    "landed_documents": r"""
        SELECT kind, namespace, n, n % 13 = 5 AND right(namespace, 1) IN ('1', '3') AS broken
        FROM (SELECT *, CAST(regexp_extract(label, '(\d+)$', 1) AS BIGINT) AS n FROM numbered_documents)
        WHERE n % 11 <> 0 OR kind = 'ksql_sources'""",
    "arrivals": """
        SELECT event_id, ts, cluster_id, metric, value, CASE WHEN event_id % 20 < 2 THEN 3
          WHEN epoch_us(ts) >= (lo + (hi - lo) * 3 // 4) * 1000000 THEN 3 WHEN epoch_us(ts) >= (lo + (hi - lo) // 4) * 1000000 THEN 2 ELSE 1 END AS batch
        FROM metric_rows, (SELECT epoch_us(min(ts)) // 1000000 AS lo, epoch_us(max(ts)) // 1000000 AS hi FROM metric_rows)""",
    "topic_heads": """
        SELECT f.env_id, regexp_replace(f.subject, '-(key|value)$', '') AS topic,
          string_agg(regexp_extract(f.subject, '(key|value)$', 1) || '.' || f.name || ':' || f.type, ',' ORDER BY f.subject, f.pos) AS fields
        FROM fields f JOIN latest l USING (env_id, subject, version) WHERE f.depth = 1 GROUP BY f.env_id, f.subject""",
    "now_jobs": "SELECT namespace, name, fp FROM history WHERE cycle = (SELECT max(cycle) FROM history)",
    "known_jobs": "SELECT namespace, name, arg_max(fp, cycle) AS fp FROM history WHERE cycle < (SELECT max(cycle) FROM history) GROUP BY namespace, name",
    "failed_now": "SELECT namespace FROM source_health WHERE cycle = (SELECT max(cycle) FROM history) AND NOT ok",
    "gone_jobs": "SELECT namespace, name FROM known_jobs WHERE (namespace, name) NOT IN (SELECT namespace, name FROM now_jobs)",
    "new_deployments": """
        SELECT CASE WHEN env_ord % 5 = 0 THEN env_id || '-b' ELSE env_id END AS env_id, env_name, cluster_id, cluster_name,
          CASE WHEN env_ord % 3 = 0 THEN 'moved:9092' ELSE kafka_bootstrap END AS kafka_bootstrap
        FROM deployments WHERE env_ord % 7 <> 0""",
    "enriched": """
        SELECT ordertime, orderid, itemid, orderunits, city, state, zipcode,
          CASE WHEN orderunits > 10 THEN 'HIGH' WHEN orderunits > 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
        FROM order_records""",
    "adjacency": """
        SELECT DISTINCT CASE side WHEN 'input' THEN d ELSE j END AS src, CASE side WHEN 'input' THEN j ELSE d END AS dst,
          CASE side WHEN 'input' THEN 'reads' ELSE 'writes' END AS kind
        FROM (SELECT side, 'job' || chr(31) || job_namespace || chr(31) || job_name AS j,
                'dataset' || chr(31) || dataset_namespace || chr(31) || dataset_name AS d FROM event_datasets)""",
    "roles": """
        SELECT node, CASE WHEN max(i) = 0 THEN 'source' ELSE 'sink' END AS role
        FROM (SELECT src AS node, 1 AS o, 0 AS i FROM adjacency UNION ALL SELECT dst, 0, 1 FROM adjacency)
        GROUP BY node HAVING max(o) = 0 OR max(i) = 0""",
    "volume_rows": """
        SELECT * FROM metric_rows WHERE metric <> 'consumer_lag_offsets' AND topic <> '' AND value IS NOT NULL""",
    "lag_rows": """
        SELECT cluster_id, consumer_group_id, ts FROM metric_rows
        WHERE metric = 'consumer_lag_offsets' AND consumer_group_id <> '' AND topic <> ''
          AND left(consumer_group_id, 1) <> '_' AND NOT starts_with(consumer_group_id, 'confluent_cli_consumer_')""",
    "span_marks": """
        SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 10 MINUTE THEN 1 ELSE 0 END AS opens
        FROM lag_rows WINDOW w AS (PARTITION BY cluster_id, consumer_group_id ORDER BY ts)""",
    "span_ids": """
        SELECT *, sum(opens) OVER (PARTITION BY cluster_id, consumer_group_id ORDER BY ts
          ROWS UNBOUNDED PRECEDING) AS span FROM span_marks""",
    "spans": """
        SELECT cluster_id, consumer_group_id, min(ts) AS active_from, max(ts) + INTERVAL 10 MINUTE AS removed_at,
          count(*) AS observations FROM span_ids GROUP BY cluster_id, consumer_group_id, span""",
}


def _uuid(h: str) -> str:
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-4' || substr({h}, 14, 3) || '-' ||"
        f" translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )


def _show(c: str) -> str:
    return f"replace({c}, chr(31), '|') AS {c.split('.')[-1]}"


DRAFT = "source_name, source_type, target_name, target_type, job_name, job_type, job_namespace"
SECONDS = "'%Y-%m-%d %H:%M:%S'"
JOB_TYPE = {
    "processingType": "CASE job_type WHEN 'tableflow' THEN 'BATCH' ELSE 'STREAMING' END",
    "integration": (
        "CASE WHEN job_type LIKE 'kafka_connect%' THEN 'KAFKA_CONNECT' WHEN job_type = 'flink_statement' THEN 'FLINK'"
        " WHEN job_type = 'ksqldb_query' THEN 'KSQLDB' WHEN job_type = 'tableflow' THEN 'TABLEFLOW' ELSE 'KAFKA' END"
    ),
    "jobType": (
        "CASE job_type WHEN 'kafka_connect_source' THEN 'SOURCE_CONNECTOR' WHEN 'kafka_connect_sink' THEN 'SINK_CONNECTOR'"
        " WHEN 'kafka_producer' THEN 'PRODUCER' WHEN 'kafka_consumer_group' THEN 'CONSUMER_GROUP'"
        " WHEN 'tableflow' THEN 'TABLE_SYNC' ELSE 'QUERY' END"
    ),
}
_W3 = "SELECT cycle, namespace, name, action FROM actions"
_EXTRA_GROUP = "NOT starts_with(consumer_group_id, 'app-1') AND NOT starts_with(consumer_group_id, 'svc-2')"
_EXTRA_CLIENT = "NOT starts_with(client_id, 'app-1') AND NOT starts_with(client_id, 'svc-2')"

FINAL: dict[str, str] = {
    "S1_read_connect_inventory": """
        SELECT coalesce(connect_cluster, replace(env_id, 'env-', 'lkc-')) || ':' || name AS id, name, status, type, env_id, connect_cluster,
          json_extract_string(config, '$."kafka.topic"') AS kafka_topic, json_extract_string(config, '$.topic') AS topic,
          json_extract_string(config, '$.topics') AS topics, json_extract_string(config, '$."kafka.topics"') AS kafka_topics
        FROM connectors""",
    "S1_payload_health": """
        SELECT CASE WHEN namespace NOT LIKE 'none://%' THEN namespace END AS namespace, kind AS source, bool_and(NOT broken) AS ok,
          count(*) AS documents, count(*) FILTER (WHERE broken) AS bad_documents
        FROM landed_documents GROUP BY CASE WHEN namespace NOT LIKE 'none://%' THEN namespace END, kind""",
    "J7_broken_documents": r"""
        SELECT job_namespace, job_name, job_type,
          CASE WHEN n % 11 <> 0 AND NOT (n % 13 = 5 AND right(job_namespace, 1) IN ('1', '3')) THEN 'SKIP'
            WHEN job_namespace IN (SELECT namespace FROM landed_documents WHERE broken) THEN 'QUARANTINED' ELSE 'ABORT' END AS action
        FROM (SELECT *, CAST(regexp_extract(job_name, '(\d+)$', 1) AS BIGINT) AS n FROM jobs)""",
    "S2_read_flink_statements": "SELECT name, env_id, status, sql_text, '' AS compute_pool FROM flink_statements",
    "S3_read_metric_rows": f"""
        SELECT cluster_id, metric, strftime(ts, {SECONDS}) AS ts, topic, consumer_group_id, client_id, value FROM metric_rows""",
    "S4_read_ksql_sources": """
        SELECT ksql_cluster_id, upper(name) AS name, CASE WHEN custkey % 3 = 0 THEN 'table-' || topic ELSE topic END AS topic
        FROM ksql_descriptions""",
    "S5_read_ksql_queries": """
        SELECT query_id, ksql_cluster_id, CASE WHEN n % 7 <> 0 THEN state ELSE 'UNKNOWN' END AS state,
          CASE WHEN n % 3 = 0 THEN 'S_' || sink_topic ELSE sink_topic END AS sinks,
          CASE WHEN n % 5 <> 0 THEN source_name || ',x' ELSE '' END AS sources
        FROM (SELECT *, CAST(substr(query_id, 6) AS BIGINT) AS n FROM ksql_queries_flat) WHERE n % 50 <> 0""",
    "S6_read_tableflow_topics": """
        SELECT env_id, topic_name, CASE WHEN n % 2 = 0 THEN status WHEN n % 5 <> 0 THEN 'PENDING' ELSE 'UNKNOWN' END AS status
        FROM (SELECT *, CAST(substr(topic_name, 7) AS BIGINT) AS n FROM tableflow_topics)
        WHERE n % 3 < 2 OR n % 4 <> 0""",
    "S7_read_topic_metadata": """
        SELECT cluster_id, topic, CASE WHEN n % 10 <> 0 THEN partitions ELSE 0 END AS partitions, replication_factor,
          n % 4 <> 0 AND is_internal AS is_internal
        FROM (SELECT *, CAST(substr(topic, 7) AS BIGINT) AS n FROM topic_metadata) WHERE n % 9 <> 0""",
    "S8_read_schema_subjects": "SELECT env_id, subject, version, schema_type, schema_text FROM subjects",
    "S9_read_environments": "SELECT env_id, env_name, cluster_id, cluster_name, kafka_bootstrap, env_ord FROM deployments",
    "S10_split_wire_format": """
        SELECT orderkey % 8 AS partition, orderkey AS "offset", CASE WHEN framed THEN custkey * 2 END AS schema_id,
          CASE WHEN framed THEN itemid END AS payload, p_name AS schema_name
        FROM (SELECT *, orderkey % 50 <> 0 AS framed FROM order_records) r
        LEFT JOIN part ON framed AND p_partkey = custkey * 2""",
    "S11_write_partitioned": "SELECT orderid, status, itemid, orderunits FROM order_records",
    "S12_create_or_replace_table": "SELECT status, count(*) AS order_count FROM order_records WHERE status IS NOT NULL GROUP BY status",
    "S13_write_run_events": f"""
        SELECT 'COMPLETE' AS event_type, '{EVENT_TIME}' AS event_time, 'tributary' AS producer, job_namespace, job_name,
          {_uuid('rh')} AS run_id, {JOB_TYPE['integration']} AS integration, n_inputs, n_outputs FROM jobs""",
    "S15_read_run_events": """
        SELECT DISTINCT job_namespace, job_name, side, dataset_namespace, dataset_name FROM event_datasets""",
    "S14_write_state": """
        SELECT namespace AS job_namespace, name AS job_name, 'job' AS job_type, sha256(arg_max(fp, cycle)) AS fingerprint,
          CAST(max(cycle) AS VARCHAR) AS last_seen_at FROM history GROUP BY namespace, name""",
    "S16_read_state": """
        SELECT namespace AS job_namespace, name AS job_name, 'job' AS job_type,
          CASE WHEN namespace <> 'ns-3' THEN sha256(arg_max(fp, cycle)) END AS fingerprint,
          CAST(max(cycle) AS VARCHAR) AS last_seen_at FROM history GROUP BY namespace, name""",
    "P1_connector_topics": "SELECT name, type, pos, topic FROM conn_topics",
    "P2_connector_edges": f"SELECT {DRAFT} FROM conn_edges",
    "P3_active_statements": "SELECT name, status FROM flink_statements WHERE upper(status) IN ('RUNNING', 'STOPPED')",
    "P4_flink_edges": f"SELECT {DRAFT}, pos_in, pos_out FROM flink_edges",
    "P5_ksql_active": f"SELECT {DRAFT} FROM ksql_edges",
    "P6_tableflow_active": "SELECT env_id, topic_name, status FROM tableflow_topics WHERE upper(status) NOT IN ('DISABLED', 'DELETED')",
    "P7_external_groups": f"""
        SELECT event_id, consumer_group_id FROM metric_rows WHERE left(consumer_group_id, 1) <> '_'
          AND NOT starts_with(consumer_group_id, 'confluent_cli_consumer_') AND {_EXTRA_GROUP}""",
    "P8_external_producers": f"""
        SELECT event_id, client_id FROM metric_rows WHERE NOT starts_with(client_id, 'connector-')
          AND NOT starts_with(client_id, '_confluent-flink_') AND {_EXTRA_CLIENT}""",
    "P9_valid_metric_rows": """
        SELECT event_id, 'throughput' AS use FROM volume_rows
        UNION ALL SELECT event_id, 'producer' FROM metric_rows WHERE client_id <> '' AND topic <> ''
        UNION ALL SELECT event_id, 'group' FROM metric_rows WHERE consumer_group_id <> '' AND topic <> ''""",
    "P10_lookback": f"""
        SELECT event_id, strftime(ts, {SECONDS}) AS ts FROM metric_rows
        WHERE ts >= TIMESTAMP '2024-01-10 12:34:00' AND ts < TIMESTAMP '2024-01-20 12:34:00'""",
    "P11_cluster_filter": "SELECT event_id, cluster_id, metric, topic FROM metric_rows WHERE cluster_id = 'lkc-2'",
    "P12_dataset_endpoints": f"SELECT {JOB}, side, dataset_type, dataset_name FROM kept_ends",
    "P13_select_by_prefix": "SELECT name, env_id FROM flink_statements WHERE starts_with(name, 'stmt-1')",
    "P14_enrich_orders": "SELECT * FROM enriched",
    "P15_high_value_alerts": """
        SELECT ordertime, orderid, itemid, orderunits, city, state, risk_tier FROM enriched WHERE risk_tier = 'HIGH'""",
    "P16_medium_risk_orders": """
        SELECT hex(CAST(orderid AS VARCHAR)) AS key, ordertime, orderid, itemid, orderunits, city, state, risk_tier
        FROM enriched WHERE risk_tier = 'MEDIUM'""",
    "P17_identity_stage": """
        SELECT ordertime, orderid, itemid, orderunits, city, state, zipcode FROM order_records WHERE orderunits >= 0""",
    "P18_job_type_facet": f"""
        SELECT job_namespace, job_name, {", ".join(f'{e} AS "{n}"' for n, e in JOB_TYPE.items())} FROM jobs""",
    "P19_namespaces": """
        SELECT topic_name, 'iceberg://tableflow' AS namespace, replace(topic_name, '-', '_') AS table_name FROM tableflow_topics
        UNION ALL SELECT topic_name, 'glue://us-east-2', 'lake.' || replace(topic_name, '-', '_') FROM tableflow_topics""",
    "P20_usage_edges": f"""
        SELECT {DRAFT}, target_namespace FROM producer_edges UNION ALL SELECT {DRAFT}, target_namespace FROM group_edges
        UNION ALL SELECT {DRAFT}, target_namespace FROM tableflow_edges""",
    "P21_edge_listing": "SELECT job_name AS job, job_type AS type, source_name AS source, target_name AS target FROM edges",
    "P22_facet_filter": """
        SELECT job_namespace, job_name, 'job' AS what FROM jobs WHERE env_id = 'env-1'
        UNION ALL SELECT DISTINCT dataset_namespace, dataset_name, 'dataset' FROM event_datasets WHERE region = 'zone-2'""",
    "J1_cross_io": "SELECT name, pos_in, input, pos_out, output FROM stmt_pairs",
    "J2_resolve_ksql_topics": "SELECT query_id, ksql_cluster_id, source, source_topic FROM ksql_resolved",
    "J3_drop_self_reference": """
        SELECT name, array_to_string(inputs, ',') AS inputs FROM stmt_refs
        UNION ALL SELECT query_id, source_topic FROM ksql_resolved WHERE source_topic <> sink_topic""",
    "J4_topics_with_schema": "SELECT env_id, topic, key_subject, key_schema_type, value_subject, value_schema_type FROM topic_schemas",
    "J5_attach_topic_facets": """
        SELECT d.job_namespace, d.job_name, d.job_type, d.side, d.dataset_namespace, d.dataset_name, s.subjects,
          m.partitions, m.is_internal, t.bytes_in, t.records_out
        FROM event_datasets d
        LEFT JOIN any_schema s ON d.dataset_type = 'kafka_topic' AND s.lookup = d.cluster_id AND s.topic = d.dataset_name
        LEFT JOIN any_metadata m ON d.dataset_type = 'kafka_topic' AND m.lookup = d.cluster_id AND m.topic = d.dataset_name
        LEFT JOIN any_throughput t ON d.dataset_type = 'kafka_topic' AND t.lookup = d.cluster_id AND t.topic = d.dataset_name""",
    "J6_stamp_topology": f"SELECT job_namespace, job_name, source_name, target_name, kafka_bootstrap, {TOPO} FROM edges",
    "J7_diff_cycle": """
        SELECT coalesce(n.namespace, k.namespace) AS job_namespace, coalesce(n.name, k.name) AS job_name,
          CASE WHEN n.fp IS NOT NULL THEN CASE WHEN n.fp = k.fp THEN 'SKIP' ELSE 'EMIT' END
            WHEN k.namespace IN (SELECT namespace FROM failed_now) THEN 'QUARANTINED' ELSE 'ABORT' END AS action
        FROM now_jobs n FULL JOIN known_jobs k ON n.namespace = k.namespace AND n.name = k.name""",
    "J8_quarantine_filter": """
        SELECT namespace AS job_namespace, name AS job_name,
          CASE WHEN namespace IN (SELECT namespace FROM failed_now) THEN 'held' ELSE 'removed' END AS fate FROM gone_jobs""",
    "J9_diff_environments": """
        SELECT coalesce(o.env_id, n.env_id) AS env_id,
          CASE WHEN o.env_id IS NULL THEN 'added' WHEN n.env_id IS NULL THEN 'removed'
            WHEN (o.env_name, o.cluster_id, o.cluster_name, o.kafka_bootstrap) = (n.env_name, n.cluster_id, n.cluster_name, n.kafka_bootstrap)
            THEN 'unchanged' ELSE 'rotated' END AS change
        FROM deployments o FULL JOIN new_deployments n ON o.env_id = n.env_id""",
    "J10_reconcile": """
        SELECT 'topic' AS kind, 'topic-' || p_partkey AS key FROM part WHERE ('topic-' || p_partkey) NOT LIKE '%3'
        UNION ALL SELECT 'statement', name FROM flink_statements WHERE status = 'RUNNING'
        UNION ALL SELECT 'connector', name FROM connectors_json""",
    "J11_job_dependencies": """
        SELECT r.dataset_namespace, r.dataset_name, r.job_namespace, r.job_name, r.role, d.writers, d.readers
        FROM (SELECT DISTINCT dataset_namespace, dataset_name, job_namespace, job_name,
                CASE side WHEN 'input' THEN 'reads' ELSE 'writes' END AS role FROM event_datasets) r
        JOIN (SELECT dataset_namespace, dataset_name,
                count(DISTINCT job_namespace || chr(31) || job_name) FILTER (WHERE side = 'output') AS writers,
                count(DISTINCT job_namespace || chr(31) || job_name) FILTER (WHERE side = 'input') AS readers
              FROM event_datasets GROUP BY ALL) d USING (dataset_namespace, dataset_name)
        WHERE writers > 0 AND readers > 0""",
    "J12_prefix_anti_join": """
        SELECT event_id, client_id FROM metric_rows WHERE client_id NOT IN (
          SELECT c.client_id FROM (SELECT DISTINCT client_id FROM metric_rows) c
          JOIN (SELECT 'svc-' || (s_suppkey * 3) AS prefix FROM supplier
                UNION SELECT 'connector-' || s_nationkey FROM supplier) p ON starts_with(c.client_id, p.prefix))""",
    "J13_stamp_event_facets": f"""
        SELECT {JOB}, side, dataset_namespace, dataset_name, """ + ", ".join(
            f"CASE WHEN dataset_type = 'kafka_topic' AND env_id || env_name || cluster_id || cluster_name || cloud || region <> ''"
            f" THEN {c} END AS \"{n}\"" for c, n in zip(
                TOPO.split(", "), ("envId", "envName", "clusterId", "clusterName", "cloud", "region"))) + """
        FROM event_datasets""",
    "A1_consumer_groups": f"SELECT * FROM groups WHERE {_EXTRA_GROUP}",
    "A2_producers": f"SELECT * FROM writers WHERE {_EXTRA_CLIENT}",
    "A3_topic_throughput": "SELECT * FROM throughput",
    "A4_job_events": f"SELECT {JOB}, 'COMPLETE' AS event_type, {_uuid('rh')} AS run_id, n_inputs, n_outputs FROM jobs",
    "A5_topology_of_job": f"SELECT {JOB}, {TOPO} FROM job_topo",
    "A6_bootstrap_of_job": f"SELECT {JOB}, kafka_bootstrap FROM job_topo",
    "A7_graph_summary": """
        SELECT (SELECT count(*) FROM connectors_json WHERE connect_cluster IS NULL) AS managed_connectors,
          (SELECT count(*) FROM connectors_json WHERE connect_cluster IS NOT NULL) AS self_managed_connectors,
          (SELECT count(*) FROM flink_statements) AS flink_statements,
          (SELECT count(*) FROM (SELECT DISTINCT cluster_id, client_id FROM writers)) AS kafka_producers,
          (SELECT count(*) FROM (SELECT DISTINCT cluster_id, consumer_group_id FROM groups)) AS consumer_groups,
          (SELECT count(*) FROM ksql_queries_flat) AS ksql_queries,
          (SELECT count(*) FROM tableflow_topics) AS tableflow_topics,
          (SELECT count(*) FROM edges) AS edges,
          (SELECT count(DISTINCT topic) FROM topic_schemas) AS topics_with_schema,
          (SELECT count(DISTINCT topic) FROM topic_metadata) AS topics_with_metadata,
          (SELECT count(DISTINCT topic) FROM throughput) AS topics_with_throughput""",
    "A8_cycle_stats": """
        SELECT cycle, count(*) FILTER (WHERE action IN ('EMIT', 'SKIP')) AS events_mapped,
          count(*) FILTER (WHERE action = 'EMIT') AS events_emitted, count(*) FILTER (WHERE action = 'SKIP') AS events_skipped,
          count(*) FILTER (WHERE action = 'ABORT') AS events_removed,
          count(*) FILTER (WHERE action = 'QUARANTINED') AS events_quarantined
        FROM actions GROUP BY cycle""",
    "A9_orders_summary": """
        SELECT status, count(*) AS order_count, '2024-02-01 00:00:00' AS computed_at FROM order_records
        WHERE status IS NOT NULL GROUP BY status""",
    "A10_component_size": f"""
        SELECT {_show('component')}, count(*) AS nodes, count(*) FILTER (WHERE node LIKE 'job' || chr(31) || '%') AS jobs,
          count(*) FILTER (WHERE node LIKE 'dataset' || chr(31) || '%') AS datasets
        FROM node_components GROUP BY component""",
    "A11_topology_rollup": """
        SELECT j.cloud, j.region, j.env_id, j.level, j.jobs, d.datasets
        FROM (SELECT cloud, region, env_id, CAST(grouping(cloud, region, env_id) AS INT) AS level, count(*) AS jobs
              FROM jobs GROUP BY ROLLUP (cloud, region, env_id)) j
        JOIN (SELECT cloud, region, env_id, CAST(grouping(cloud, region, env_id) AS INT) AS level,
                count(DISTINCT dataset_namespace || chr(31) || dataset_name) AS datasets
              FROM event_datasets GROUP BY ROLLUP (cloud, region, env_id)) d
          ON j.cloud IS NOT DISTINCT FROM d.cloud AND j.region IS NOT DISTINCT FROM d.region
          AND j.env_id IS NOT DISTINCT FROM d.env_id AND j.level = d.level""",
    "A12_metric_minute_rollup": f"""
        SELECT strftime(date_trunc('minute', ts), {SECONDS}) AS minute, cluster_id, metric, round(sum(value), 2) AS value
        FROM metric_rows GROUP BY date_trunc('minute', ts), cluster_id, metric""",
    "A13_known_keys": f"SELECT DISTINCT {JOB} FROM edges",
    "W1_first_seen_dataset": f"""
        SELECT {JOB}, side, dataset_type, dataset_name, declared_namespace, source_name AS first_source,
          target_name AS first_target FROM first_seen""",
    "W2_last_env_wins": """
        SELECT topic, cluster_id, bytes_in, bytes_out, records_in, records_out, window_minutes FROM merged_throughput""",
    "W3_diff_history": _W3,
    "W4_latest_schema_version": "SELECT env_id, subject, version, schema_type, schema_text FROM latest",
    "W5_last_healthy_cycle": """
        SELECT namespace, recovered_at, min(cycle) AS failed_from, max(cycle) AS failed_to, count(*) AS failed_cycles, last_healthy
        FROM (SELECT f.namespace, f.cycle,
                (SELECT min(g.cycle) FROM source_health g WHERE g.namespace = f.namespace AND g.ok AND g.cycle > f.cycle) AS recovered_at,
                (SELECT max(g.cycle) FROM source_health g WHERE g.namespace = f.namespace AND g.ok AND g.cycle < f.cycle) AS last_healthy
              FROM source_health f WHERE NOT f.ok)
        GROUP BY namespace, recovered_at, last_healthy""",
    "O1_sorted_bindings": """
        SELECT 'group' AS kind, cluster_id, consumer_group_id AS id, topic FROM groups
        UNION ALL SELECT 'producer', cluster_id, client_id, topic FROM writers ORDER BY 1, 2, 3, 4""",
    "O2_sorted_throughput": "SELECT * FROM throughput ORDER BY topic, cluster_id",
    "O3_sorted_dataset_keys": """
        SELECT job_namespace, job_name,
          string_agg(dataset_name, ',' ORDER BY dataset_namespace, dataset_name) FILTER (WHERE side = 'input') AS inputs,
          string_agg(dataset_name, ',' ORDER BY dataset_namespace, dataset_name) FILTER (WHERE side = 'output') AS outputs
        FROM event_datasets GROUP BY job_namespace, job_name, job_type""",
    "O4_summary_by_status": """
        SELECT status, count(*) AS order_count FROM order_records WHERE status IS NOT NULL GROUP BY status ORDER BY status""",
    "O5_busiest_topics": "SELECT * FROM throughput ORDER BY bytes_in DESC, cluster_id, topic LIMIT 20",
    "U1_lineage_edges": f"""
        SELECT {DRAFT}, target_namespace, kafka_bootstrap, {TOPO}, scope, env_ord, builder, pos_in, pos_out FROM edges""",
    "U2_removed_keys": "SELECT namespace AS job_namespace, name AS job_name FROM gone_jobs",
    "U3_failed_namespaces": """
        SELECT DISTINCT namespace FROM source_health WHERE namespace NOT IN (
          SELECT namespace FROM source_health WHERE cycle = (SELECT max(cycle) FROM history) AND ok AND namespace <> 'ns-5')""",
    "U4_graph_topics": "SELECT * FROM graph_topics",
    "U5_environment_sets": """
        SELECT env_id, 'added' AS side FROM new_deployments WHERE env_id NOT IN (SELECT env_id FROM deployments)
        UNION ALL SELECT env_id, 'removed' FROM deployments WHERE env_id NOT IN (SELECT env_id FROM new_deployments)
        UNION ALL SELECT env_id, 'common' FROM deployments WHERE env_id IN (SELECT env_id FROM new_deployments)""",
    "F1_strip_sql_comments": "SELECT name, s AS sql_text FROM stmt_clean",
    "F2_extract_outputs": "SELECT name, array_to_string(outputs, ',') AS outputs FROM stmt_names",
    "F3_extract_inputs": "SELECT name, array_to_string(read, ',') AS inputs FROM stmt_names",
    "F4_drop_keywords": rf"""
        SELECT name, array_to_string(list_filter(regexp_split_to_array(sql_text, '\s+'), lambda w: upper(w) NOT IN ({STOP})), ' ') AS words
        FROM flink_statements""",
    "F5_parse_cloud_region": """
        SELECT env_id, CASE WHEN managed THEN parts[-3] ELSE '' END AS cloud, CASE WHEN managed THEN parts[-4] ELSE '' END AS region
        FROM (SELECT *, len(parts) >= 5 AND parts[-2] = 'confluent' AND parts[-1] = 'cloud' AS managed
              FROM (SELECT *, string_split(split_part(kafka_bootstrap, ':', 1), '.') AS parts FROM deployments))""",
    "F6_stable_run_id": f"""
        SELECT name, {_uuid('h')} AS run_id FROM (SELECT name, sha256(env_id || ':' || name || ':{CYCLE}') AS h FROM flink_statements)""",
    "F7_fingerprint": f"SELECT {JOB}, fingerprint FROM jobs",
    "F8_iceberg_table_name": "SELECT topic_name, replace(topic_name, '-', '_') AS table_name FROM tableflow_topics",
    "F9_render_avro_type": "SELECT subject, version, field, type FROM fields WHERE schema_type = 'AVRO'",
    "F10_avro_fields": "SELECT subject, version, field, depth, pos, description FROM fields WHERE schema_type = 'AVRO'",
    "F11_json_schema_fields": "SELECT subject, version, field, depth, pos, type FROM fields WHERE schema_type = 'JSON'",
    "F12_protobuf_field": "SELECT subject, version, field, type, description FROM fields WHERE schema_type = 'PROTOBUF'",
    "F13_schema_facet_fields": """
        SELECT f.env_id, regexp_replace(f.subject, '-(key|value)$', '') AS topic, regexp_extract(f.subject, '(key|value)$', 1) AS part,
          f.depth, CASE WHEN f.depth = 1 THEN regexp_extract(f.subject, '(key|value)$', 1) || '.' || f.name ELSE f.name END AS name,
          f.type, f.description
        FROM fields f JOIN latest l USING (env_id, subject, version)""",
    "F14_cycle_key": "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS cycle_key FROM metric_rows",
    "F15_floor_minute": f"SELECT event_id, strftime(date_trunc('minute', ts), {SECONDS}) AS minute FROM metric_rows",
    "F16_abort_run_id": f"""
        SELECT cycle, namespace, name, {_uuid('h')} AS run_id FROM (
          SELECT *, sha256(namespace || ':' || name || ':abort:' || cycle) AS h FROM actions WHERE action = 'ABORT')""",
    "F17_job_key": "SELECT DISTINCT job_namespace || '/' || job_name AS job_key, job_type FROM edges",
    "F18_run_event_json": f"""
        SELECT j.job_namespace, j.job_name, {_uuid('j.rh')} AS run_id, i.dataset_name AS first_input, m.partitions,
          o.dataset_namespace AS first_output_namespace, t.bytes_in
        FROM jobs j
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {JOB} ORDER BY dataset_namespace, dataset_name) AS rn
                   FROM event_datasets WHERE side = 'input') WHERE rn = 1) i USING ({JOB})
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {JOB} ORDER BY dataset_namespace, dataset_name) AS rn
                   FROM event_datasets WHERE side = 'output') WHERE rn = 1) o USING ({JOB})
        LEFT JOIN any_metadata m ON i.dataset_type = 'kafka_topic' AND m.lookup = i.cluster_id AND m.topic = i.dataset_name
        LEFT JOIN any_throughput t ON o.dataset_type = 'kafka_topic' AND t.lookup = o.cluster_id AND t.topic = o.dataset_name""",
    "F18_schema_facet": """
        SELECT e.job_namespace, e.job_name, e.side, e.dataset_namespace, e.dataset_name, s.fields
        FROM event_datasets e LEFT JOIN (
          SELECT 'lkc-' || substr(env_id, 5) AS lookup, * FROM topic_heads UNION ALL SELECT '', * FROM topic_heads) s
        ON e.dataset_type = 'kafka_topic' AND s.lookup = e.cluster_id AND s.topic = e.dataset_name""",
    "G1_lineage_adjacency": f"SELECT {_show('src')}, {_show('dst')}, kind FROM adjacency",
    "G2_reach": f"SELECT {_show('node')}, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY node",
    "G2_reach_by_seed": f"""
        SELECT direction, {_show('seed')}, {_show('node')}, min(depth) AS depth FROM seed_walk GROUP BY direction, seed, node""",
    "G3_components": f"SELECT {_show('node')}, {_show('component')} FROM node_components",
    "G4_endpoints": f"SELECT {_show('node')}, role FROM roles",
    "T1_run_cycles": """
        SELECT CAST(c.cycle AS VARCHAR) AS cycle, events_mapped, events_emitted, events_skipped, events_removed, events_quarantined
        FROM (SELECT cycle, count(*) FILTER (WHERE action IN ('EMIT', 'SKIP')) AS events_mapped,
          count(*) FILTER (WHERE action = 'EMIT') AS events_emitted, count(*) FILTER (WHERE action = 'SKIP') AS events_skipped,
          count(*) FILTER (WHERE action = 'ABORT') AS events_removed,
          count(*) FILTER (WHERE action = 'QUARANTINED') AS events_quarantined
        FROM real_actions GROUP BY cycle) c""",
    "T1_cycles_of_all_sources": """
        SELECT CAST(c AS VARCHAR) AS cycle, count(*) FILTER (WHERE here) AS events_mapped, count(*) FILTER (WHERE here AND NOT known) AS events_emitted,
          count(*) FILTER (WHERE here AND known) AS events_skipped, count(*) FILTER (WHERE known AND NOT here AND NOT held) AS events_removed,
          count(*) FILTER (WHERE known AND NOT here AND held) AS events_quarantined
        FROM (SELECT c, n % 5 <> c AND NOT held AS here, held,
            c > 1 AND n % 5 <> CASE WHEN c = 4 AND starts_with(job_namespace, 'kafka-connect://') THEN 2 ELSE c - 1 END AS known
          FROM (SELECT *, c = 3 AND starts_with(job_namespace, 'kafka-connect://') AS held FROM recent_jobs, (VALUES (1), (2), (3), (4)) AS w(c)))
        GROUP BY c""",
    "T2_stateful_diff": _W3,
    "T2_keyed_diff": "SELECT cycle, namespace, name, action FROM patchy_actions",
    "T3_sliding_throughput": f"""
        SELECT strftime(s, {SECONDS}) AS window_start, strftime(s + INTERVAL 10 MINUTE, {SECONDS}) AS window_end, cluster_id, topic, """
        + ", ".join(
            f"coalesce(sum(trunc(value)::BIGINT) FILTER (WHERE metric = '{m}'), 0)::BIGINT AS {c}"
            for m, c in (("received_bytes", "bytes_in"), ("sent_bytes", "bytes_out"),
                         ("received_records", "records_in"), ("sent_records", "records_out"))) + """
        FROM (SELECT *, date_trunc('minute', ts) - to_minutes(k) AS s FROM volume_rows, (SELECT unnest(range(10)) AS k))
        WHERE s + INTERVAL 10 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 MINUTE FROM volume_rows)
        GROUP BY s, cluster_id, topic""",
    "T4_late_metrics": f"""
        SELECT strftime(date_trunc('minute', ts), {SECONDS}) AS minute, cluster_id, metric, round(sum(value), 2) AS value
        FROM metric_rows
        WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE
          <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 MINUTE FROM metric_rows)
        GROUP BY date_trunc('minute', ts), cluster_id, metric""",
    "T4_repaired_minutes": f"""
        SELECT strftime(date_trunc('minute', ts), {SECONDS}) AS minute, cluster_id, metric, round(sum(value), 2) AS value,
          CAST(count(*) FILTER (WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= seen - INTERVAL 3 MINUTE) AS BIGINT) AS late_rows
        FROM arrivals JOIN (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
          FROM arrivals GROUP BY batch) s USING (batch)
        WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 3 MINUTE FROM arrivals)
        GROUP BY date_trunc('minute', ts), cluster_id, metric""",
    "T5_inactive_groups": """
        SELECT cluster_id, consumer_group_id, strftime(active_from, '%Y-%m-%d %H:%M:%S.%f') AS active_from,
          strftime(removed_at, '%Y-%m-%d %H:%M:%S.%f') AS removed_at, observations FROM spans
        WHERE removed_at <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 MINUTE FROM lag_rows)""",
    "T5_silent_groups": """
        SELECT cluster_id, consumer_group_id, strftime(active_from, '%Y-%m-%d %H:%M:%S.%f') AS active_from,
          strftime(removed_at, '%Y-%m-%d %H:%M:%S.%f') AS removed_at, observations FROM spans""",
    "T5_group_spans_batch": """
        SELECT cluster_id, consumer_group_id, strftime(active_from, '%Y-%m-%d %H:%M:%S.%f') AS active_from,
          strftime(removed_at, '%Y-%m-%d %H:%M:%S.%f') AS removed_at FROM spans""",
    "T6_recover_state": _W3,
    "T7_orders_stream": """
        SELECT CASE risk_tier WHEN 'HIGH' THEN 'high_value_alerts' ELSE 'medium_risk_orders' END AS sink,
          ordertime, orderid, itemid, orderunits, city, state, risk_tier FROM enriched WHERE risk_tier <> 'LOW'""",
    "T8_reload_dimension": """
        SELECT r.event_id, r.env_id, d.env_name, d.kafka_bootstrap
        FROM (SELECT event_id, 'env-' || substr(cluster_id, 5) AS env_id FROM metric_rows) r LEFT JOIN deployments d USING (env_id)""",
    "T8_versions_as_of": """
        SELECT r.event_id, r.env_id, d.env_name, d.kafka_bootstrap
        FROM (SELECT event_id, 'env-' || substr(cluster_id, 5) AS env_id, epoch_us(ts) AS at FROM metric_rows) r
        LEFT JOIN (
          SELECT v.since, v.until, d.* FROM (
            SELECT env_id, env_name, kafka_bootstrap, 0 AS version FROM deployments
            UNION ALL SELECT env_id, env_name, kafka_bootstrap, 1 FROM new_deployments
            UNION ALL SELECT env_id, env_name || '-v3', CASE WHEN env_ord % 2 = 0 THEN '' ELSE kafka_bootstrap END, 3 FROM deployments) d
          JOIN (SELECT version, since, lead(since, 1, 9000000000000000) OVER (ORDER BY version) AS until FROM (
            SELECT version, (lo + (hi - lo) * version // 4) * 1000000 AS since
            FROM (SELECT epoch_us(min(ts)) // 1000000 AS lo, epoch_us(max(ts)) // 1000000 AS hi FROM metric_rows), (VALUES (0), (1), (3)) AS w(version))) v
          USING (version)) d
        ON r.env_id = d.env_id AND r.at >= d.since AND r.at < d.until""",
    "T9_at_least_once_emit": """
        SELECT cycle, namespace, name, CASE WHEN name LIKE '%7' AND action = 'SKIP' THEN 'EMIT' ELSE action END AS action FROM actions""",
    "T9_delivery_ledger": """
        SELECT cycle, namespace, name, action, CASE WHEN name NOT LIKE '%7' THEN cycle WHEN later IS NOT NULL THEN later END AS arrived_round,
          CAST(CASE WHEN name LIKE '%7' AND later IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS tries
        FROM actions JOIN (SELECT cycle, lead(cycle) OVER (ORDER BY cycle) AS later FROM (SELECT DISTINCT cycle FROM actions WHERE action IN ('EMIT', 'ABORT'))) USING (cycle)
        WHERE action IN ('EMIT', 'ABORT')""",
    "X1_flatten_schemas": "SELECT env_id, subject, version, field, depth, pos, name, type, description FROM fields",
    "X2_schema_drift": """
        SELECT 'part-' || partkey AS subject, field, old_type, new_type,
          CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'retyped' END AS change
        FROM (SELECT coalesce(o.partkey, n.partkey - 1) AS partkey, coalesce(o.field, n.field) AS field,
                o.type AS old_type, n.type AS new_type
              FROM part_fields o FULL JOIN (SELECT * FROM part_fields WHERE partkey > 0) n
                ON o.partkey = n.partkey - 1 AND o.field = n.field)
        WHERE old_type IS DISTINCT FROM new_type""",
}

# Blocks that need WITH RECURSIVE, and the history of jobs that have edges at all.
BLOCKS |= {
    "walk": """
        SELECT node, 0 AS depth FROM roles WHERE role = 'source'
        UNION SELECT a.dst, w.depth + 1 FROM walk w JOIN adjacency a ON a.src = w.node WHERE w.depth < 40""",
    "both_steps": "SELECT 'downstream' AS direction, src AS here, dst AS there FROM adjacency UNION ALL SELECT 'upstream', dst, src FROM adjacency",
    "seed_walk": """
        SELECT DISTINCT d.direction, node AS seed, node, 0 AS depth FROM (SELECT src AS node FROM adjacency UNION SELECT dst FROM adjacency),
          (VALUES ('downstream'), ('upstream')) AS d(direction) WHERE starts_with(node, 'job' || chr(31) || 'kafka-connect://')
        UNION SELECT s.direction, w.seed, s.there, w.depth + 1 FROM seed_walk w JOIN both_steps s ON s.here = w.node AND s.direction = w.direction
        WHERE w.depth < 3""",
    "links": """
        SELECT DISTINCT a.d AS a, b.d AS b FROM
          (SELECT job_namespace || chr(31) || job_name AS j, 'dataset' || chr(31) || dataset_namespace || chr(31) || dataset_name AS d
           FROM event_datasets) a
          JOIN (SELECT job_namespace || chr(31) || job_name AS j, 'dataset' || chr(31) || dataset_namespace || chr(31) || dataset_name AS d
           FROM event_datasets) b USING (j)""",
    "closure": "SELECT a, b FROM links UNION SELECT c.a, l.b FROM closure c JOIN links l ON l.a = c.b",
    "dataset_components": "SELECT a AS node, min(b) AS component FROM closure GROUP BY a",
    "node_components": """
        SELECT node, component FROM dataset_components
        UNION ALL SELECT DISTINCT 'job' || chr(31) || e.job_namespace || chr(31) || e.job_name, c.component
        FROM event_datasets e JOIN dataset_components c
          ON c.node = 'dataset' || chr(31) || e.dataset_namespace || chr(31) || e.dataset_name""",
    "real_history": "SELECT cycle, namespace, name, fp FROM (SELECT *, input_topic || '>' || output_topic AS fp FROM job_cycles WHERE input_topic <> output_topic)",
    "real_grid": """
        SELECT j.namespace, j.name, h.cycle, h.ok, c.fp FROM (SELECT namespace, name, min(cycle) AS c0 FROM real_history GROUP BY ALL) j
        JOIN source_health h ON h.namespace = j.namespace AND h.cycle >= j.c0
        LEFT JOIN real_history c ON c.namespace = j.namespace AND c.name = j.name AND c.cycle = h.cycle""",
    "real_carried": """
        SELECT *, last_value(seen IGNORE NULLS) OVER (PARTITION BY namespace, name ORDER BY cycle
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
        FROM (SELECT *, CASE WHEN fp IS NOT NULL OR ok THEN coalesce(fp, '') END AS seen FROM real_grid)""",
    "real_actions": """
        SELECT cycle, namespace, name, CASE WHEN fp IS NOT NULL THEN CASE WHEN fp = prev THEN 'SKIP' ELSE 'EMIT' END
          WHEN ok THEN 'ABORT' ELSE 'QUARANTINED' END AS action
        FROM real_carried WHERE fp IS NOT NULL OR (prev IS NOT NULL AND prev <> '')""",
}

# The same history where some health never came, which counts as failed.
BLOCKS["patchy_health"] = "SELECT cycle, namespace, ok AND NOT (namespace = 'ns-2' AND cycle % 2 = 1) AS ok FROM source_health"
for _block, _over in (("grid", "source_health"), ("observed", "grid"), ("carried", "observed"), ("actions", "carried")):
    _name = "patchy_health" if _over == "source_health" else f"patchy_{_over}"
    BLOCKS[f"patchy_{_block}"] = re.sub(rf"\b{_over}\b", _name, BLOCKS[_block])

# The jobs of all sources, those of metrics within a window before the last row's minute.
BLOCKS["recent_rows"] = """SELECT * FROM metric_rows WHERE ts >= (SELECT date_trunc('minute', max(ts)) - INTERVAL 14400 MINUTE FROM metric_rows)
    AND ts < (SELECT date_trunc('minute', max(ts)) FROM metric_rows)"""
for _block, _over in (("groups", "metric_rows"), ("writers", "metric_rows"), ("producer_edges", "writers"), ("group_edges", "groups")):
    BLOCKS[f"recent_{_block}"] = re.sub(rf"FROM {_over}\b", "FROM recent_" + ("rows" if _over == "metric_rows" else _over), BLOCKS[_block])
BLOCKS["recent_drafts"] = re.sub(r"\b(producer|group)_edges\b", r"recent_\1_edges", BLOCKS["drafts"])
BLOCKS["recent_jobs"] = (
    r"SELECT DISTINCT job_namespace, job_name, CAST(regexp_extract(job_name, '(\d+)$', 1) AS BIGINT) AS n FROM recent_drafts")

_TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"}


def _mentions(sql: str) -> list[str]:
    words = set(re.findall(r"(?:FROM|JOIN|,)\s+\(?([a-z_]+)", sql))
    return [name for name in BLOCKS if name in words]


def _complete(final: str) -> str:
    order: list[str] = []

    def need(sql: str, own: str | None = None) -> None:
        for name in _mentions(sql):
            if name != own and name not in order:
                need(BLOCKS[name], name)
                if name not in order:
                    order.append(name)

    need(final)
    if not order:
        return final.strip()
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name].strip()})" for name in order)
    return f"WITH RECURSIVE {blocks}\n{final.strip()}"


ORACLES: dict[str, str] = {name: _complete(sql) for name, sql in FINAL.items()}
