import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle

import glossaflow
from glossaflow.session import local_session

cloudpickle.register_pickle_by_value(glossaflow)


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "glossaflow-tests", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
