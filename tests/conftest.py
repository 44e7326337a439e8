from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import check_oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = check_oracle.session(4)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    session.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return check_oracle.duck(SF)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def interpreted(spark):
    """Compiling a plan costs more than running it over a handful of rows."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
