import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from entwise.session import SCALE_CONF
    scratch = tempfile.mkdtemp(prefix="entwise-test-")
    b = (SparkSession.builder.master("local[*]").appName("entwise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
         .config("spark.driver.memory", "8g"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="entwise-case-")


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison (None sorts first)."""
    cols = cols or tuple(df.columns)
    key = lambda t: tuple((v is not None, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
