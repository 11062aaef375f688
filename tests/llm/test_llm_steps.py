"""Steps are there until they are dropped, and files have names of their own."""

import os

from tributary.llm.shared_files import input_stream, new_file, output
from tributary.llm.steps import Steps


def test_steps_are_written_and_given_back(spark):
    steps = Steps(spark)
    one = steps.keep(spark.range(5), "one")
    two = steps.keep(one.selectExpr("id * 2 AS id"), "two")
    (folder,) = {os.path.dirname(f) for f in one.inputFiles()}
    folder = folder.removeprefix("file://")
    assert os.path.isdir(folder)
    steps.drop("one")
    assert not os.path.exists(folder) and two.count() == 5


def test_files_by_uri_and_path(tmp_path):
    names = {new_file(root, ".x") for root in (str(tmp_path), f"file://{tmp_path}") for _ in range(3)}
    assert len(names) == 6
    for name in names:
        with output(name) as f:
            f.write(b"abc")
        with input_stream(name) as f:
            assert f.read() == b"abc"
