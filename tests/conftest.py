"""One local session for all tests; its checkpoint folder is temporary."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="tidemark-tests-")
    conf = {"spark.master": "local[4]", "spark.driver.memory": "6g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": folder}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(folder)
    yield session
    session.stop()
