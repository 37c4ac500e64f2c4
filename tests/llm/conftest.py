import hashlib
import re

import pytest

TABLES = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def with_clashes(df):
    """The frame with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    names = ["row", "n", "key", "rank", "start", "end", "shard", "salt", "spans", "found", "a", "b", "_salt", "h"]
    return df.withColumns({n: F.lit(1) for n in names if n not in df.columns})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(pattern, text):
    return re.findall(pattern, lowered(text))
