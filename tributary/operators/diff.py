"""What changed: the diff of one cycle against known state, and of a whole history at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import RESOURCE_KINDS
from tributary.operators.ordered import neighbours, positions_and_next
from tributary.schemas import JOB_KEY

EMIT, SKIP, ABORT, QUARANTINED = "EMIT", "SKIP", "ABORT", "QUARANTINED"

# Width of an order block (cycles) for the split windows.
BLOCK = 4096


def failed_namespaces(health: DataFrame) -> DataFrame:
    """Namespaces with a failed source, from rows (namespace, ok)."""
    failed = health.where(~F.coalesce("ok", F.lit(False)) & F.col("namespace").isNotNull())
    return failed.select("namespace").distinct()


def combined_health(*parts: DataFrame) -> DataFrame:
    """(namespace, ok): a namespace is healthy if all its rows are, whichever part they are in."""
    rows = reduce(DataFrame.union, [p.select("namespace", "ok") for p in parts])
    return rows.where("namespace IS NOT NULL").groupBy("namespace").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok"))


def expected_health(health: DataFrame, expected: DataFrame) -> DataFrame:
    """Health of every expected namespace; one without a row counts as failed."""
    return expected.select("namespace").distinct().join(health, "namespace", "left").select(
        "namespace", F.coalesce("ok", F.lit(False)).alias("ok"),
    )


def known_keys(jobs: DataFrame) -> DataFrame:
    return jobs.select(*JOB_KEY).distinct()


def removed_keys(state: DataFrame, jobs: DataFrame) -> DataFrame:
    """Known jobs that are absent now."""
    return state.select(*JOB_KEY).join(jobs.select(*JOB_KEY), list(JOB_KEY), "left_anti")


def quarantine_filter(keys: DataFrame, failed: DataFrame, keep: bool) -> DataFrame:
    """Rows in a failed namespace (`keep=True`) or outside all of them."""
    names = failed.select(F.col("namespace").alias("job_namespace")).distinct()
    return keys.join(names, "job_namespace", "left_semi" if keep else "left_anti")


def diff_cycle(jobs: DataFrame, state: DataFrame, failed: DataFrame, force: bool = False) -> DataFrame:
    """One row per job that is present or known, with its action.

    Present: EMIT when new, changed or forced, else SKIP. Absent: QUARANTINED when its source
    failed, else ABORT. A job whose type has changed is present under another key: its old key
    is left out, as the job lives on. Job keys are unique on both sides, so no join has a hot key.
    """
    now = jobs.select(*JOB_KEY, F.col("fingerprint").alias("now_fp"), F.lit(True).alias("_present"))
    known = state.select(
        *JOB_KEY, F.col("fingerprint").alias("known_fp"), "last_seen_at", F.lit(True).alias("_known"),
    )
    both = now.join(known, list(JOB_KEY), "full_outer")
    name = ["job_namespace", "job_name"]
    both = both.join(jobs.select(*name, F.lit(True).alias("_alive")).distinct(), name, "left")
    both = both.where("_present IS NOT NULL OR _alive IS NULL")
    names = failed.select(
        F.col("namespace").alias("job_namespace"), F.lit(True).alias("_failed"),
    ).distinct()
    present = F.col("_present").isNotNull()
    same = F.col("now_fp").eqNullSafe(F.col("known_fp")) & F.col("_known").isNotNull()
    action = (
        F.when(present & same & F.lit(not force), SKIP).when(present, EMIT)
        .when(F.col("_failed").isNotNull(), QUARANTINED).otherwise(ABORT)
    )
    return both.join(names, "job_namespace", "left").select(
        *JOB_KEY, action.alias("action"), "now_fp", "known_fp", "last_seen_at",
    )


def next_state(diff: DataFrame, seen_at: Column, undelivered: DataFrame | None = None) -> DataFrame:
    """State after the cycle. Removed jobs are gone; quarantined ones keep their row; a job whose
    delivery failed (`undelivered`, keyed like jobs) stays known with its old fingerprint, so it
    is sent again next time."""
    rows = diff.where(F.col("action") != ABORT)
    if undelivered is not None:
        lost = undelivered.select(*JOB_KEY, F.lit(True).alias("_lost")).distinct()
        rows = rows.join(lost, list(JOB_KEY), "left")
    else:
        rows = rows.withColumn("_lost", F.lit(None).cast("boolean"))
    delivered = (F.col("action") == EMIT) & F.col("_lost").isNull()
    present = F.col("action").isin(EMIT, SKIP)
    return rows.select(
        *JOB_KEY,
        F.when(delivered, F.col("now_fp")).otherwise(F.col("known_fp")).alias("fingerprint"),
        F.when(present, seen_at).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
    )


def cycle_stats(diff: DataFrame, undelivered: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of mapped, emitted, skipped, removed and quarantined jobs. Failed deliveries count
    as skipped."""
    rows = diff.withColumn("_lost", F.lit(False))
    if undelivered is not None:
        lost = undelivered.select(*JOB_KEY, F.lit(True).alias("_lost")).distinct()
        rows = diff.join(lost, list(JOB_KEY), "left").withColumn("_lost", F.coalesce("_lost", F.lit(False)))
    action, sent = F.col("action"), ~F.col("_lost")
    return rows.groupBy(*by).agg(
        F.count_if(action.isin(EMIT, SKIP)).alias("events_mapped"),
        F.count_if((action == EMIT) & sent).alias("events_emitted"),
        F.count_if((action == SKIP) | ((action == EMIT) & ~sent)).alias("events_skipped"),
        F.count_if(action == ABORT).alias("events_removed"),
        F.count_if(action == QUARANTINED).alias("events_quarantined"),
    )


def health_outlook(health: DataFrame, block: int = BLOCK) -> DataFrame:
    """Health rows (namespace, cycle, ok) with their position in the namespace's history (`pos`
    of `total`) and cycle and position of the next healthy cycle."""
    rows = health.select("namespace", "cycle", F.coalesce("ok", F.lit(False)).alias("ok"))
    return positions_and_next(
        rows, ["namespace"], "cycle", F.floor(F.col("cycle") / block), F.col("ok"),
    ).withColumnsRenamed({"next_order": "next_ok", "next_pos": "next_ok_pos"})


def diff_history(job_cycles: DataFrame, health: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every action of every cycle from the whole history, in one pass.

    `job_cycles` has one row per job and cycle it was present in (cycle, namespace, name, fp);
    `health` one row per namespace and cycle (namespace, cycle, ok). Only the gaps in a job's
    history are expanded: a job is aborted in the first healthy cycle of a gap, and quarantined
    in the failed cycles before it. No job x cycle grid is built. Where a namespace has jobs in a cycle but
    no health row, it counts as failed in it: its jobs are compared, the absent ones held.
    """
    keys = ["namespace", "name"]
    own = health.select("namespace", "cycle", "ok")
    unseen = job_cycles.select("namespace", "cycle").distinct().join(
        own.select("namespace", "cycle").distinct(), ["namespace", "cycle"], "left_anti",
    )
    health = own.unionByName(unseen.withColumn("ok", F.lit(False)))
    outlook = health_outlook(health, block)
    seen = job_cycles.select("cycle", *keys, "fp").join(
        outlook.drop("ok"), ["namespace", "cycle"],
    )
    rows = neighbours(
        seen, keys, "cycle", F.floor(F.col("cycle") / block),
        previous={"prev_fp": "fp", "prev_next_ok": "next_ok"},
        following={"next_cycle": "cycle", "next_cycle_pos": "pos"},
    )
    was_removed = F.coalesce(F.col("prev_next_ok") < F.col("cycle"), F.lit(False))
    unchanged = F.coalesce(F.col("fp") == F.col("prev_fp"), F.lit(False)) & ~was_removed
    aborted = F.col("next_ok").isNotNull() & (
        F.col("next_cycle").isNull() | (F.col("next_ok") < F.col("next_cycle"))
    )
    # The quarantined stretch ends at the next presence, the next healthy cycle, or never.
    stretch_end = F.least(
        F.coalesce("next_cycle_pos", F.col("total") + 1), F.coalesce("next_ok_pos", F.col("total") + 1),
    )
    stretch = F.when(stretch_end - F.col("pos") > 1, F.sequence(F.col("pos") + 1, stretch_end - 1))
    marks = F.filter(F.array(
        F.struct(
            F.when(unchanged, SKIP).otherwise(EMIT).alias("action"),
            F.col("cycle").alias("at"), F.lit(None).cast("bigint").alias("at_pos"),
        ),
        F.when(aborted, F.struct(
            F.lit(ABORT).alias("action"), F.col("next_ok").alias("at"),
            F.lit(None).cast("bigint").alias("at_pos"),
        )),
    ), lambda m: m.isNotNull())
    held = F.transform(F.coalesce(stretch, F.array().cast("array<bigint>")), lambda p: F.struct(
        F.lit(QUARANTINED).alias("action"), F.lit(None).cast(job_cycles.schema["cycle"].dataType).alias("at"),
        p.alias("at_pos"),
    ))
    placed = rows.select(*keys, F.inline(F.concat(marks, held)))
    # Positions become cycles again. Rows that know their cycle need no partner; they get
    # positions below zero, which match nothing and are spread over all partitions.
    nowhere = -1 - F.pmod(F.xxhash64("name", "at"), F.lit(1 << 20))
    placed = placed.withColumn("at_pos", F.coalesce("at_pos", nowhere))
    calendar = outlook.select("namespace", F.col("pos").alias("at_pos"), F.col("cycle").alias("_cycle"))
    return placed.join(calendar, ["namespace", "at_pos"], "left").select(
        F.coalesce("at", "_cycle").alias("cycle"), *keys, "action",
    )


def failed_spells(health: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of failed cycles per namespace: how long its jobs were quarantined, the healthy cycle
    before (NULL if none) and the cycle it recovered in (NULL if it has not)."""
    outlook = health_outlook(health, block)
    rows = neighbours(
        outlook, ["namespace"], "cycle", F.floor(F.col("cycle") / block),
        previous={"prev_cycle": "cycle"},
    )
    return rows.where(~F.col("ok")).groupBy("namespace", "next_ok").agg(
        F.min("cycle").alias("failed_from"), F.max("cycle").alias("failed_to"),
        F.count("*").alias("failed_cycles"), F.min_by("prev_cycle", "cycle").alias("last_healthy"),
    ).withColumnRenamed("next_ok", "recovered_at")


def environment_signature(env: DataFrame, columns: list[str]) -> DataFrame:
    """(env_id, signature): one hash over the columns whose change matters. NULL and '' differ."""
    parts = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return env.select("env_id", F.sha2(parts, 256).alias("signature"))


def diff_environments(old: DataFrame, new: DataFrame) -> DataFrame:
    """(env_id, change): added, removed, rotated (same id, other signature) or unchanged."""
    both = old.select("env_id", F.col("signature").alias("old_sig")).join(
        new.select("env_id", F.col("signature").alias("new_sig")), "env_id", "full_outer",
    )
    change = (
        F.when(F.col("old_sig").isNull(), "added").when(F.col("new_sig").isNull(), "removed")
        .when(F.col("old_sig") == F.col("new_sig"), "unchanged").otherwise("rotated")
    )
    return both.select("env_id", change.alias("change"))


def environment_sets(old: DataFrame, new: DataFrame) -> DataFrame:
    """(env_id, side) by plain set operations: added, removed, common."""
    def ids(df: DataFrame) -> DataFrame:
        return df.select("env_id")

    added = ids(new).subtract(ids(old)).withColumn("side", F.lit("added"))
    removed = ids(old).subtract(ids(new)).withColumn("side", F.lit("removed"))
    common = ids(old).intersect(ids(new)).withColumn("side", F.lit("common"))
    return added.union(removed).union(common)


def reconcile(state: DataFrame, actual: DataFrame) -> DataFrame:
    """State rows (kind, key) that still exist. A kind with an empty actual listing keeps all its
    rows: the listing may simply have failed.

    The kinds found are at most as many as there are resource kinds, so that side is broadcast;
    the keys go through an ordinary join.
    """
    listed = actual.where(F.col("kind").isin(*RESOURCE_KINDS))
    kinds = F.broadcast(listed.select("kind").distinct().withColumn("_listed", F.lit(True)))
    found = listed.select("kind", "key").distinct().withColumn("_found", F.lit(True))
    marked = state.join(kinds, "kind", "left").join(found, ["kind", "key"], "left")
    return marked.where(F.col("_listed").isNull() | F.col("_found").isNotNull()).drop("_listed", "_found")
