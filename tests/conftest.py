import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tributary.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tributary-tests", cpus=os.environ.get("TEST_CPUS", "8"), memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


@pytest.fixture
def env_dim(spark):
    return spark.createDataFrame(
        [
            ("env-a", "alpha", "lkc-a", "cluster_0", "pkc-1.us-east-2.aws.confluent.cloud:9092", 0),
            ("env-b", "beta", "lkc-b", "cluster_1", "pkc-2.eu-west-1.gcp.confluent.cloud:9092", 1),
        ],
        "env_id string, env_name string, cluster_id string, cluster_name string,"
        " kafka_bootstrap string, env_ord int",
    )


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: tuple(str(v) for v in r))
