"""The diff as state inside the stream, a part of a namespace's jobs to each group.

Rows are jobs seen in a cycle and the health of namespaces in a cycle, in any order; `at` is the event time of their
cycle. A cycle is compared once the watermark has passed it, by a timer of its group, so the outcome does
not depend on how rows are dealt to batches. Rows that come later than the watermark allows are dropped.

A namespace's jobs are spread over `buckets` groups by a hash of their names, so that a namespace with a third of all
jobs is not in one task; what concerns the whole namespace (its health, and that it was seen) goes to all its
groups: `buckets` small rows for each namespace and cycle. A group keeps its known jobs and the rows of cycles
that are still open.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tributary.operators.diff import ABORT, EMIT, QUARANTINED, SKIP

BUCKETS = 8
OUTPUT = "cycle long, namespace string, name string, action string"
# Rows of jobs in one block of state.
BLOCK = 100_000
_JOBS = pa.schema([("name", pa.string()), ("fp", pa.string())])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that arbitrary state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _packed(rows: pa.Table) -> Iterator[bytes]:
    """Jobs with fingerprints as Arrow streams of at most `BLOCK` rows: a call to the state for each block, not for each row."""
    for start in range(0, rows.num_rows, BLOCK):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _JOBS) as out:
            out.write_table(rows.slice(start, BLOCK))
        yield sink.getvalue().to_pybytes()


def _unpacked(block: bytes) -> Iterator[tuple[str, str | None]]:
    rows = pa.ipc.open_stream(bytes(block)).read_all()
    return zip(rows.column("name").to_pylist(), rows.column("fp").to_pylist(), strict=True)


def _worse(ok: int, before: int) -> int:
    return min(ok, before) if -1 not in (ok, before) else max(ok, before)


class CycleDiff(StatefulProcessor):
    """State of one group: known jobs with fingerprints and rows of open cycles, both in numbered blocks, and the health of
    open cycles. A timer reads and removes the blocks of its own cycle; rows of later ones stay where they are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = handle.getMapState("known", "block long", "jobs binary")
        self._known_blocks = handle.getValueState("known_blocks", "blocks long")
        self._rows = handle.getMapState("rows", "cycle long, block long", "jobs binary")
        self._row_blocks = handle.getMapState("row_blocks", "cycle long", "blocks long")
        self._open = handle.getMapState("open", "at long", "cycle long, ok int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        jobs: dict[int, list[pa.Table]] = {}
        health: dict[int, tuple[int, int]] = {}
        for part in rows:
            for cycle, own in part[part["name"].notna()].groupby("cycle"):
                jobs.setdefault(int(cycle), []).append(pa.Table.from_pandas(own[["name", "fp"]], _JOBS, preserve_index=False))
                # What has come in this call is put away once it fills a block.
                if sum(t.num_rows for t in jobs[int(cycle)]) >= BLOCK:
                    self._append(int(cycle), jobs.pop(int(cycle)))
            for at, own in part.groupby("at_ms"):
                # 0: failed, 1: healthy, -1: not heard of; a failed row outweighs a healthy one.
                told = own["ok"].dropna()
                ok = -1 if told.empty else int(told.astype(bool).all())
                first, before = health.get(int(at), (int(own["cycle"].iloc[0]), -1))
                health[int(at)] = (first, _worse(ok, before))
        for cycle, tables in jobs.items():
            self._append(cycle, tables)
        for at, (cycle, ok) in health.items():
            if self._open.containsKey((at,)):
                # The cycle that came first with this time keeps it.
                cycle, before = self._open.getValue((at,))
                ok = _worse(ok, before)
            else:
                self._handle.registerTimer(at)
            self._open.updateValue((at,), (cycle, ok))
        return iter(())

    def _append(self, cycle: int, tables: list[pa.Table]) -> None:
        blocks = self._row_blocks.getValue((cycle,))[0] if self._row_blocks.containsKey((cycle,)) else 0
        for blocks, block in enumerate(_packed(pa.concat_tables(tables)), blocks + 1):
            self._rows.updateValue((cycle, blocks - 1), (block,))
        self._row_blocks.updateValue((cycle,), (blocks,))

    def _taken(self, cycle: int) -> dict[str, str | None]:
        """The jobs seen in a cycle, which leave the state; of several rows of a job the one that came last."""
        seen: dict[str, str | None] = {}
        if self._row_blocks.containsKey((cycle,)):
            for block in range(self._row_blocks.getValue((cycle,))[0]):
                seen.update(_unpacked(self._rows.getValue((cycle, block))[0]))
                self._rows.removeKey((cycle, block))
            self._row_blocks.removeKey((cycle,))
        return seen

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        cycle, ok = self._open.getValue((at,))
        self._open.removeKey((at,))
        seen = self._taken(cycle)
        before = self._known_blocks.get()[0] if self._known_blocks.exists() else 0
        known: dict[str, str | None] = {}
        for block in range(before):
            known.update(_unpacked(self._known.getValue((block,))[0]))
        actions = [(name, SKIP if name in known and known[name] == fp else EMIT) for name, fp in seen.items()]
        for name in [n for n in known if n not in seen]:
            actions.append((name, ABORT if ok == 1 else QUARANTINED))
            if ok == 1:
                del known[name]
        known |= seen
        after = 0
        for after, block in enumerate(_packed(pa.table([list(known), list(known.values())], schema=_JOBS)), 1):
            self._known.updateValue((after - 1,), (block,))
        for block in range(after, before):
            self._known.removeKey((block,))
        self._known_blocks.update((after,))
        if actions:
            yield pd.DataFrame({"cycle": cycle, "namespace": key[0], "name": [n for n, _ in actions], "action": [a for _, a in actions]})

    def close(self) -> None:
        pass


def follow_jobs(jobs: DataFrame, health: DataFrame, lag: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Actions (cycle, namespace, name, action) of streams of jobs (cycle, at, namespace, name, fp) and of health (cycle, at,
    namespace, ok). A namespace with jobs but without health in a cycle counts as failed in it. Start the query in
    `keyed_state`; a cycle comes out when rows of a later one have moved the watermark."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    own = F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int").alias("bucket")
    cycle = F.col("cycle").cast("long").alias("cycle")
    none = F.lit(None)
    # One watermark over both: either stream moves it on.
    both = jobs.select(cycle, "at", "namespace", "name", "fp", none.cast("boolean").alias("ok")).union(health.select(
        cycle, "at", "namespace", none.cast("string").alias("name"), none.cast("string").alias("fp"), F.coalesce("ok", F.lit(False)).alias("ok")))
    both = both.withWatermark("at", lag)
    # Conditions on `at` too: others would be pushed below the watermark, which then saw one stream only.
    job, told = (both.where(f"CASE WHEN at IS NULL THEN false ELSE name IS {kind} END") for kind in ("NOT NULL", "NULL"))
    seen = job.select("cycle", "at", "namespace").dropDuplicates()
    seen = seen.select("*", none.cast("string").alias("name"), none.cast("string").alias("fp"), none.cast("boolean").alias("ok"))
    rows = job.select("*", own).union(seen.select("*", numbers)).union(told.select("*", numbers))
    rows = rows.select("namespace", "bucket", "cycle", "at", F.unix_millis("at").alias("at_ms"), "name", "fp", "ok")
    return rows.groupBy("namespace", "bucket").transformWithStateInPandas(
        statefulProcessor=CycleDiff(), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")
