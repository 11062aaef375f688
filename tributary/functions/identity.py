"""Namespaces, run ids and other identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed_values import (
    DEFAULT_JOB_TYPE_FACET, DEFAULT_TABLE_NAMESPACE, JOB_TYPE_FACETS, MANAGED_HOST_SUFFIX,
)
from tributary.functions.text import non_empty


def cloud_region(bootstrap: Column) -> tuple[Column, Column]:
    """(cloud, region) read from `<id>.<region>.<cloud>.<suffix>:<port>`, else empty texts."""
    host = F.substring_index(F.coalesce(bootstrap, F.lit("")), ":", 1)
    parts = F.split(host, r"\.")
    tail = F.slice(parts, -2, 2)
    managed = (F.size(parts) >= 5) & (tail == F.array(*[F.lit(p) for p in MANAGED_HOST_SUFFIX]))

    def part(i: int) -> Column:
        return F.when(managed, F.try_element_at(parts, F.lit(i))).otherwise(F.lit(""))

    return part(-3), part(-4)


def stable_run_id(namespace: Column, name: Column, salt: Column) -> Column:
    """UUID text (version 4 layout) from the first 16 bytes of SHA-256 of `namespace:name:salt`."""
    h = F.sha2(F.concat_ws(":", namespace, name, salt), 256)
    variant = F.translate(h.substr(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-", h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("4"), h.substr(14, 3)),
        F.concat(variant, h.substr(18, 3)), h.substr(21, 12),
    )


def abort_run_id(namespace: Column, name: Column, salt: Column) -> Column:
    """Run id of a removal. Derived, so a retried cycle writes the same document."""
    return stable_run_id(namespace, name, F.concat(F.lit("abort:"), salt))


def job_key_text(namespace: Column, name: Column) -> Column:
    """Display text of a job key; joins use the pair, since `a/b`+`c` reads like `a`+`b/c`."""
    return F.concat_ws("/", namespace, name)


def table_name_of_topic(topic: Column) -> Column:
    return F.translate(topic, "-", "_")


def synced_table(topic: Column, region: str | None, database: str | None) -> tuple[Column, Column]:
    """(namespace, name) of the table a topic is synced to."""
    name = table_name_of_topic(topic)
    if region and database:
        return F.lit(f"glue://{region}"), F.concat(F.lit(f"{database}."), name)
    return F.lit(DEFAULT_TABLE_NAMESPACE), name


def topic_namespace(bootstrap: Column) -> Column:
    return F.concat(F.lit("kafka://"), bootstrap)


def table_namespace(target_namespace: Column) -> Column:
    return F.coalesce(non_empty(target_namespace), F.lit(DEFAULT_TABLE_NAMESPACE))


def job_type_facet(job_type: Column) -> Column:
    """struct<processingType, integration, jobType>; unknown types keep their upper-cased name."""
    known = F.create_map(*[
        x for k, v in JOB_TYPE_FACETS.items()
        for x in (F.lit(k), F.struct(*[
            F.lit(t).alias(n) for n, t in zip(("processingType", "integration", "jobType"), v)
        ]))
    ])
    processing, integration = DEFAULT_JOB_TYPE_FACET
    fallback = F.struct(
        F.lit(processing).alias("processingType"), F.lit(integration).alias("integration"),
        F.upper(job_type).alias("jobType"),
    )
    return F.coalesce(F.try_element_at(known, job_type), fallback)
