"""The diff in keyed state against a plain replay of the cycles."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.operators import diff
from tributary.streaming import keyed

JOBS, HEALTH = "cycle long, namespace string, name string, fp string", "cycle long, namespace string, ok boolean"


class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.at = spark, {n: str(tmp_path / n) for n in ("jobs", "health", "out", "chk")}

    def land(self, jobs, health):
        for name, items, kind in (("jobs", jobs, JOBS), ("health", health, HEALTH)):
            df = self.spark.createDataFrame(items, kind).withColumn("at", F.timestamp_seconds(F.col("cycle") * 60))
            df.coalesce(1).write.mode("append").parquet(self.at[name])

    def run(self, buckets, lag="0 seconds"):
        read = lambda name, kind: self.spark.readStream.schema(f"{kind}, at timestamp").parquet(self.at[name])
        with keyed.keyed_state(self.spark):
            stream = keyed.follow_jobs(read("jobs", JOBS), read("health", HEALTH), lag, buckets)
            stream.writeStream.format("parquet").outputMode("append").option("path", self.at["out"]).option(
                "checkpointLocation", self.at["chk"]).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, self.spark.read.schema(keyed.OUTPUT).parquet(self.at["out"]).collect()))


def replay(jobs, health):
    known, out = {}, []
    for c in sorted({r[0] for r in jobs} | {r[0] for r in health}):
        for ns in sorted({r[1] for r in [*jobs, *health] if r[0] == c}):
            seen = {n: fp for cc, s, n, fp in jobs if (cc, s) == (c, ns)}
            told = [ok for cc, s, ok in health if (cc, s) == (c, ns)]
            own = known.setdefault(ns, {})
            out += [(c, ns, n, "SKIP" if n in own and own[n] == fp else "EMIT") for n, fp in seen.items()]
            healthy = bool(told) and all(told)
            for n in [n for n in own if n not in seen]:
                out.append((c, ns, n, "ABORT" if healthy else "QUARANTINED"))
                if healthy:
                    del own[n]
            own |= seen
    return sorted(out)


@pytest.mark.parametrize("buckets", [1, 4])
def test_equals_a_replay_over_restarts(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    jobs = [(c, ns, f"j{k}", str(rng.randint(0, 1))) for c in range(1, 9) for ns in "ab" for k in range(6) if rng.random() < 0.6]
    health = [(c, ns, rng.choice([True, True, False, None])) for c in range(1, 9) for ns in "ab" if rng.random() < 0.8]
    health += [(5, "a", True), (5, "a", False)]
    feed = Feed(spark, tmp_path)
    for part in ((1, 2, 3), (4, 5), (6, 7, 8)):
        feed.land([r for r in jobs if r[0] in part], [r for r in health if r[0] in part])
        feed.run(buckets)
    feed.land([], [(99, "", True)])
    assert feed.run(buckets) == replay(jobs, health)
    # The batch form of the same history agrees.
    batch = diff.diff_history(
        spark.createDataFrame(jobs, JOBS), spark.createDataFrame([(c, ns, ok) for (c, ns), ok in {
            (c, ns): all(o for cc, s, o in health if (cc, s) == (c, ns)) for c, ns, _ in health}.items()], "cycle long, namespace string, ok boolean"))
    assert sorted((r.cycle, r.namespace, r.name, r.action) for r in batch.collect()) == replay(jobs, health)


def test_rows_in_any_order_within_the_lag(spark, tmp_path):
    """Parts of a cycle come with later cycles; what is later than the lag allows is dropped."""
    feed = Feed(spark, tmp_path)
    feed.land([(1, "a", "x", "1")], [(2, "a", True)])
    feed.run(2, "3 minutes")
    feed.land([(2, "a", "x", "1"), (1, "a", "y", "1")], [(1, "a", True), (3, "a", True)])
    feed.run(2, "3 minutes")
    feed.land([(4, "a", "x", "2")], [(9, "", True)])
    feed.run(2, "3 minutes")
    feed.land([(1, "a", "late", "1")], [(30, "", True)])
    assert feed.run(2, "3 minutes") == [
        (1, "a", "x", "EMIT"), (1, "a", "y", "EMIT"), (2, "a", "x", "SKIP"), (2, "a", "y", "ABORT"), (3, "a", "x", "ABORT"), (4, "a", "x", "EMIT")]


def test_open_cycles_stay_in_their_blocks(spark, tmp_path, monkeypatch):
    """Rows of five open cycles are each written once and read once, in blocks, however many cycles end after them."""
    calls = []

    class Map(dict):
        def __init__(self, name):
            self.name = name

        def containsKey(self, key):
            return key in self

        def getValue(self, key):
            calls.append(("get", self.name, key))
            return self[key]

        def updateValue(self, key, value):
            calls.append(("put", self.name, key))
            self[key] = value

        def removeKey(self, key):
            self.pop(key, None)

    class Value:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def getMapState(self, name, *_):
            return Map(name)

        def getValueState(self, name, *_):
            return Value()

        def registerTimer(self, at):
            pass

    class Timer:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

    monkeypatch.setattr(keyed, "BLOCK", 4)
    group = keyed.CycleDiff()
    group.init(Handle())
    rows = pd.DataFrame([(c, c * 1000, f"j{k}", "x" if k else str(c), True) for c in range(1, 6) for k in range(10)],
                        columns=["cycle", "at_ms", "name", "fp", "ok"])
    list(group.handleInputRows(("a", 0), iter([rows[:25], rows[25:]]), None))
    out = pd.concat([part for c in range(1, 6) for part in group.handleExpiredTimer(("a", 0), None, Timer(c * 1000))])
    assert dict(out.groupby("cycle").size()) == {c: 10 for c in range(1, 6)}
    assert dict(out["action"].value_counts()) == {"EMIT": 14, "SKIP": 36}
    for kind in ("put", "get"):
        blocks = [key for what, name, key in calls if (what, name) == (kind, "rows")]
        assert len(blocks) == len(set(blocks)) <= 20
    assert not group._rows and not group._row_blocks
