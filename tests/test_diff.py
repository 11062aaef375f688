"""Diffs: one cycle, the whole history, state, environments, reconciliation."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tributary.operators import diff
from tributary.operators.ordered import neighbours, positions_and_next
from tributary.schemas import STATE
from tributary.sources import state as store

JOBS = "job_namespace string, job_name string, job_type string, fingerprint string"


def jobs(spark, items):
    return spark.createDataFrame([(ns, n, "t", fp) for ns, n, fp in items], JOBS)


def known(spark, items):
    return spark.createDataFrame([(ns, n, "t", fp, "before") for ns, n, fp in items], STATE)


def failed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "namespace string")


def test_one_cycle(spark):
    now = jobs(spark, [("a", "new", "1"), ("a", "same", "1"), ("a", "changed", "2"), ("a", "undelivered", "1"), ("q", "here", "1")])
    old = known(spark, [("a", "same", "1"), ("a", "changed", "1"), ("a", "gone", "1"), ("q", "gone", "1"), ("q", "here", "1"), ("a", "undelivered", None)])
    got = diff.diff_cycle(now, old, failed(spark, "q"))
    assert rows(got, "job_namespace", "job_name", "action") == [
        ("a", "changed", "EMIT"), ("a", "gone", "ABORT"), ("a", "new", "EMIT"), ("a", "same", "SKIP"),
        ("a", "undelivered", "EMIT"), ("q", "gone", "QUARANTINED"), ("q", "here", "SKIP")]
    forced = diff.diff_cycle(now, old, failed(spark, "q"), force=True)
    assert {r.action for r in forced.collect() if r.now_fp} == {"EMIT"}
    lost = jobs(spark, [("a", "new", "1")])
    after = diff.next_state(got, F.lit("now"), lost)
    assert rows(after, "job_namespace", "job_name", "fingerprint", "last_seen_at") == [
        ("a", "changed", "2", "now"), ("a", "new", None, "now"), ("a", "same", "1", "now"),
        ("a", "undelivered", "1", "now"), ("q", "gone", "1", "before"), ("q", "here", "1", "now")]
    assert diff.cycle_stats(got, lost).first().asDict() == {
        "events_mapped": 5, "events_emitted": 2, "events_skipped": 3, "events_removed": 1, "events_quarantined": 1}


def test_namespace_match_is_exact(spark):
    got = diff.diff_cycle(jobs(spark, []), known(spark, [("flink://e1", "j", "1"), ("flink://e", "j", "1")]), failed(spark, "flink://e"))
    assert rows(got, "job_namespace", "action") == [("flink://e", "QUARANTINED"), ("flink://e1", "ABORT")]


def test_missing_health_counts_as_failed(spark):
    health = spark.createDataFrame([("a", True), ("b", False)], "namespace string, ok boolean")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "namespace string")
    assert rows(diff.failed_namespaces(diff.expected_health(health, expected))) == [("b",), ("c",)]


def test_quarantine_then_recovery(spark):
    """Seen, then the source fails, then it is healthy and empty."""
    history = spark.createDataFrame([(1, "n", "j", "x")], "cycle int, namespace string, name string, fp string")
    health = spark.createDataFrame([(1, "n", True), (2, "n", False), (3, "n", True), (4, "n", True)], "cycle int, namespace string, ok boolean")
    assert rows(diff.diff_history(history, health), "cycle", "action") == [(1, "EMIT"), (2, "QUARANTINED"), (3, "ABORT")]


def model(history, health):
    """Cycle by cycle, with carried state. Jobs without a health row: their source counts as failed."""
    state, out = {}, []
    for cycle in sorted({c for c, *_ in health} | {c for c, *_ in history}):
        present = {(ns, n): fp for c, ns, n, fp in history if c == cycle}
        ok = {ns: False for ns, _ in present} | {ns: o for c, ns, o in health if c == cycle}
        for key, fp in present.items():
            out.append((cycle, *key, "SKIP" if state.get(key) == fp else "EMIT"))
        for key in [k for k in state if k not in present and k[0] in ok]:
            if ok[key[0]]:
                out.append((cycle, *key, "ABORT"))
                del state[key]
            else:
                out.append((cycle, *key, "QUARANTINED"))
        state.update(present)
    return sorted(out, key=lambda r: tuple(str(v) for v in r))


@pytest.mark.parametrize("seed,block", [(1, 1), (2, 3), (3, 7), (4, 4096)])
def test_history_equals_the_sequential_model(spark, seed, block):
    rnd = random.Random(seed)
    cycles = range(1, 31)
    health = [(c, ns, rnd.random() < 0.6) for c in cycles for ns in ("n1", "n2") if rnd.random() < 0.8]
    history = [(c, ns, f"j{j}", str(rnd.randint(1, 2))) for ns in ("n1", "n2") for j in range(6) for c in cycles if rnd.random() < 0.5]
    # A job that owns a third of all rows: present in every cycle.
    history += [(c, "n1", "hot", str(c // 4)) for c in cycles for _ in (0,)]
    got = diff.diff_history(
        spark.createDataFrame(history, "cycle int, namespace string, name string, fp string"),
        spark.createDataFrame(health, "cycle int, namespace string, ok boolean"), block=block)
    assert rows(got, "cycle", "namespace", "name", "action") == model(history, health)


def test_a_job_that_changes_type_is_not_removed(spark):
    columns = "job_namespace string, job_name string, job_type string, fingerprint string"
    now = spark.createDataFrame([("n", "j", "sink", "2"), ("n", "k", "sink", "1")], columns)
    before = spark.createDataFrame([("n", "j", "source", "1", "t"), ("n", "gone", "source", "1", "t")], columns + ", last_seen_at string")
    got = diff.diff_cycle(now, before, spark.createDataFrame([], "namespace string"))
    assert rows(got, "job_name", "job_type", "action") == [("gone", "source", "ABORT"), ("j", "sink", "EMIT"), ("k", "sink", "EMIT")]
    state = diff.next_state(got, F.lit("t2"))
    assert rows(state, "job_name", "job_type") == [("j", "sink"), ("k", "sink")]


def test_split_windows_equal_plain_ones(spark):
    rnd = random.Random(5)
    data = [(k, o, rnd.random() < 0.2) for k in "ab" for o in rnd.sample(range(500), 90 if k == "a" else 5)]
    df = spark.createDataFrame(data, "k string, o int, flag boolean")
    block = F.floor(F.col("o") / 10)
    got = neighbours(df, ["k"], "o", block, previous={"p": "o"}, following={"n": "o"})
    want, pos = {}, {}
    for k in "ab":
        order = sorted((o, f) for kk, o, f in data if kk == k)
        for i, (o, _) in enumerate(order):
            want[k, o] = (order[i - 1][0] if i else None, order[i + 1][0] if i + 1 < len(order) else None)
            later = [(j, x) for j, (x, f) in enumerate(order) if f and x > o]
            pos[k, o] = (i + 1, len(order), later[0][1] if later else None, later[0][0] + 1 if later else None)
    assert {(r.k, r.o): (r.p, r.n) for r in got.collect()} == want
    placed = positions_and_next(df, ["k"], "o", block, F.col("flag"))
    assert {(r.k, r.o): (r.pos, r.total, r.next_order, r.next_pos) for r in placed.collect()} == pos


def test_failed_spells(spark):
    oks = [True, False, False, True, False]
    df = spark.createDataFrame([(c, "n", ok) for c, ok in enumerate(oks, 1)] + [(1, "m", False), (2, "m", True)],
                               "cycle int, namespace string, ok boolean")
    got = diff.failed_spells(df, block=2)
    assert rows(got, "namespace", "failed_from", "failed_to", "failed_cycles", "last_healthy", "recovered_at") == [
        ("m", 1, 1, 1, None, 2), ("n", 2, 3, 2, 1, 4), ("n", 5, 5, 1, 4, None)]


def test_state_round_trip_and_crash_safety(spark, tmp_path):
    path = str(tmp_path / "state")
    assert store.read_state(spark, path).count() == 0
    first = known(spark, [("n", f"j{i}", str(i)) for i in range(500)])
    store.write_state(first, path, "0001")
    assert store.read_state(spark, path).count() == 500
    store.write_state(known(spark, [("n", "a", None), ("n", "b", "")]), path, "0002")
    assert rows(store.read_state(spark, path), "job_name", "fingerprint") == [("a", None), ("b", None)]
    assert store.read_state(spark, path, before="0002").count() == 500
    first.limit(1).write.parquet(f"{path}/v=0003")
    assert store.published_cycle(spark, path) == "0002"


def test_environments(spark):
    def env(items):
        df = spark.createDataFrame(items, "env_id string, cluster_id string, kafka_bootstrap string")
        return diff.environment_signature(df, df.columns)
    old = env([("a", "c", "h"), ("b", "c", "h"), ("d", "c", None)])
    new = env([("d", "c", ""), ("a", "c", "h"), ("x", "c", "h")])
    assert rows(diff.diff_environments(old, new)) == [("a", "unchanged"), ("b", "removed"), ("d", "rotated"), ("x", "added")]
    assert rows(diff.environment_sets(old, new)) == [("a", "common"), ("b", "removed"), ("d", "common"), ("x", "added")]


def test_reconcile_keeps_kinds_with_an_empty_listing(spark):
    state = spark.createDataFrame([("topic", "a"), ("topic", "b"), ("connector", "c"), ("statement", "s")], "kind string, key string")
    actual = spark.createDataFrame([("topic", "a"), ("topic", "z"), ("statement", "other")], "kind string, key string")
    assert rows(diff.reconcile(state, actual)) == [("connector", "c"), ("topic", "a")]
    assert diff.reconcile(state, actual.limit(0)).count() == 4


def test_pruned_versions_are_gone_and_their_cycles_stay_published(spark, tmp_path):
    path = str(tmp_path / "state")
    store.prune(spark, path)  # nothing there yet
    for k in range(1, 7):
        store.write_state(known(spark, [("n", f"j{k}", "1")]).coalesce(1), path, f"{k:02d}")
        if k == 4:
            store.prune(spark, path, keep=2)
    store.prune(spark, path, keep=2)
    store.prune(spark, path, keep=2)
    assert rows(store.read_state(spark, path), "job_name") == [("j6",)] and rows(store.read_state(spark, path, before="06"), "job_name") == [("j5",)]
    assert all(store.is_published(spark, path, f"{k:02d}") for k in range(1, 7)) and store.published_cycle(spark, path) == "06"
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["gathered", "published", "v=05", "v=06"]
    assert len(list((tmp_path / "state" / "gathered").iterdir())) == 1
    with pytest.raises(store.PrunedError):
        store.read_state(spark, path, before="04")
    assert store.read_state(spark, path, before="01").count() == 0
