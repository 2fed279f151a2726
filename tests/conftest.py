import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlake.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they look once every table is too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def files_of(spark, monkeypatch):
    """Of a module: a list that gets the number of files of each table it stores, with many shuffle partitions."""
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)

    def of(module) -> list[int]:
        counts, stored = [], module.stored

        def counted(df, *args):
            out = stored(df, *args)
            counts.append(len(out.inputFiles()))
            return out

        monkeypatch.setattr(module, "stored", counted)
        return counts

    yield of
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def d(text):
    return Decimal(text)
