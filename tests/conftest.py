from __future__ import annotations

import glob
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    at = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.local.dir": str(at / "local"), "spark.sql.warehouse.dir": str(at / "wh"), "spark.checkpoint.dir": f"file://{at}/shared",
    }
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def rows_of(pdf) -> list[tuple]:
    """Rows of a pandas frame with columns by name, in a total order, missing values and floats made comparable."""

    def one(x):
        if x is None or str(x) in ("<NA>", "NaT", "nan"):
            return ""
        if isinstance(x, float):
            return f"{x:.6g}"
        return str(x)

    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(map(one, r)) for r in pdf.itertuples(index=False))
