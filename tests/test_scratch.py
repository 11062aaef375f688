"""What is written on the way goes when it has been read."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tributary.plans import cycle as plan
from tributary.plans import registered
from tributary.session import drop, scratch_path, scratch_tables, write_and_reload
from tributary.sources import run_events


def folder(table):
    return os.path.dirname(table.inputFiles()[0]).removeprefix("file://")


def test_tables_of_a_block_go_at_its_end(spark):
    before = write_and_reload(spark.range(3), "before")
    with scratch_tables():
        outer = write_and_reload(spark.range(5), "outer")
        with scratch_tables():
            places = [folder(inner := write_and_reload(outer.where("id > 1"), "inner"))]
            assert inner.count() == 3
        assert not os.path.exists(places[0]) and outer.count() == 5
        early, places = write_and_reload(outer, "early"), [folder(outer)]
        places.append(folder(early))
        drop(early, spark.range(1))
        assert [os.path.exists(p) for p in places] == [True, False]
    assert not os.path.exists(places[0]) and before.count() == 3
    with pytest.raises(ValueError), scratch_tables():
        places = [folder(write_and_reload(spark.range(5), "failed"))]
        raise ValueError
    assert not os.path.exists(places[0])


def test_shuffle_files_go_with_the_write(spark):
    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if os.path.basename(f).startswith("shuffle_")}

    before = left()
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert sorted(map(tuple, write_and_reload(rows, "counted").collect())) == [(k, 100) for k in range(10)]
    assert not left() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_cycle_leaves_its_documents_and_its_state(spark, env_dim, tmp_path):
    root, state, docs = (str(tmp_path / n) for n in ("landings", "state", "events"))
    os.makedirs(f"{root}/1/flink/env_id=env-a")
    with open(f"{root}/1/flink/env_id=env-a/x.json", "w") as f:
        f.write(json.dumps([{"name": f"s{k}", "statement": f"INSERT INTO b{k} SELECT * FROM a", "status": "RUNNING"} for k in range(20)]))
    health = spark.createDataFrame([("flink://env-a", True)], "namespace string, ok boolean")
    seen = []
    step = plan.landing_step(spark, root, env_dim, lambda cycle: health, state_path=state, events_path=docs, on_stats=lambda cycle, stats: seen.append(stats))
    written = os.path.dirname(scratch_path(spark, "any")).removeprefix("file:")
    before = set(glob.glob(f"{written}/*"))
    step("1", "t", frozenset())
    assert set(glob.glob(f"{written}/*")) == before
    assert seen[0].first().asDict() == {
        "events_mapped": 20, "events_emitted": 20, "events_skipped": 0, "events_removed": 0, "events_quarantined": 0, "cycle": "1"}
    files = glob.glob(f"{docs}/cycle=1/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert run_events.read_run_events(spark, docs).count() == 20


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data here")
def test_a_search_by_seed_leaves_what_its_answer_is_read_from(spark):
    written = os.path.dirname(scratch_path(spark, "any")).removeprefix("file:")
    before = set(glob.glob(f"{written}/*"))
    answer = registered.QUERIES["G2_reach_by_seed"](spark, "/root/testdata/sf0.001")
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in set(glob.glob(f"{written}/*")) - before}
    assert left and not left & {"edges", "datasets", "adjacency", "links", "steps", "kinds", "groups"}
    assert answer.count() > 0
