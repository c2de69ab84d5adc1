from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.master": "local[8]", "spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.local.dir": work, "spark.sql.warehouse.dir": f"{work}/warehouse", "spark.driver.extraJavaOptions": f"-Dderby.system.home={work}"}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(tables):
    import duckdb

    con = duckdb.connect()
    for path in Path(tables).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(frame) -> list[tuple]:
    """The rows of a pandas frame, columns by name, in a fixed order."""

    def plain(x):
        x = x.item() if hasattr(x, "item") else x
        if x is pd.NA:
            x = None
        if isinstance(x, float):  # a column of integers with nulls comes as floats
            x = None if x != x else int(x) if x.is_integer() else x
        return str(x)

    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))
