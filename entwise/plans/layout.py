"""Address tables in a bucketed layout, for joins without an exchange.

The address jobs join the same large tables on the same keys every time. Stored in
buckets of those keys, with equal numbers of buckets, they are joined bucket by
bucket and nothing of them is shuffled. A bucket cannot be split when a job runs,
so a key that very many rows share is dealt beforehand: the large side's buckets
are by the key and a salt from the row, and the key sets they are joined with hold
every key once for each salt.

``store`` writes the layout; the shuffles happen there, once for each new version
of a table. ``government_keys`` and ``classify`` give the rows of the operators in
``operators.address``. Key sets that a job derives (the addresses of government
locations, the government keys) are written in buckets too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.address import GOVT_SQL, address_key_sql
from entwise.operators.address import GOVT_KEY, base_flags, derived_flags, government_source_rows
from entwise.operators.skew import SALTS

SALT = "ew_salt"


class Layout:
    """Bucketed tables named ``prefix`` + name, with their files under ``path``."""

    def __init__(self, spark: SparkSession, prefix: str, path: str, buckets: int):
        self.spark, self.prefix, self.path, self.buckets = spark, prefix, path.rstrip("/"), buckets

    def _write(self, df: DataFrame, name: str, key: str) -> None:
        # one file for each bucket: rows are dealt as the buckets are
        (df.repartition(self.buckets, key, SALT).write.mode("overwrite").format("parquet")
         .bucketBy(self.buckets, key, SALT).sortBy(key, SALT)
         .option("path", f"{self.path}/{name}").saveAsTable(self.prefix + name))

    def put_rows(self, df: DataFrame, name: str, key: str) -> None:
        """The large side: every row with a salt from its columns and where it comes from."""
        h = F.xxhash64(F.monotonically_increasing_id(), *[F.col(c) for c in df.columns])
        self._write(df.withColumn(SALT, F.pmod(h, F.lit(SALTS)).cast("int")), name, key)

    def put_keys(self, df: DataFrame, name: str, key: str) -> None:
        """A set of keys, with other columns that depend on the key: each key once for each salt."""
        keys = df.filter(F.col(key).isNotNull()).distinct()
        self._write(keys.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), name, key)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)

    def drop(self) -> None:
        """Forget the tables; their files stay."""
        for t in self.spark.catalog.listTables():
            if t.name.startswith(self.prefix.lower()):
                self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def store(layout: Layout, address: DataFrame, location_addresses: DataFrame, naics_source: DataFrame,
          entity_location_assoc: DataFrame, operating_locations: DataFrame,
          excluded_supplier: int = S.GOVT_EXCLUDED_SUPPLIER, years: Sequence[str] = S.GOVT_YEARS,
          activity: Sequence[str] = S.GOVT_ACTIVITY) -> None:
    """Write the layout of the five source tables."""
    layout.put_rows(location_addresses.select("lvid", "ain"), "places", "lvid")
    layout.put_keys(government_source_rows(naics_source, excluded_supplier, years), "govt_locations", "lvid")
    active = operating_locations.filter(F.substring("ol_activity_ind", 1, 1).isin(*activity)).select("pbin")
    layout.put_keys(entity_location_assoc.select("lvid", "pbin").join(active, "pbin", "left_semi").select("lvid"),
                    "active_locations", "lvid")
    layout.put_rows(address.selectExpr("ain", f"trim({address_key_sql(with_unit=True)}) AS {GOVT_KEY}"), "address_keys", "ain")
    layout.put_rows(derived_flags(base_flags(address)), "addresses", GOVT_KEY)


def government_keys(layout: Layout) -> DataFrame:
    """The rows of ``operators.address.government_keys``."""
    on = ["lvid", SALT]
    places = layout.table("places").join(layout.table("govt_locations"), on, "left_semi") \
        .join(layout.table("active_locations"), on, "left_semi")
    layout.put_keys(places.select("ain"), "govt_addresses", "ain")
    keys = layout.table("address_keys").join(layout.table("govt_addresses"), ["ain", SALT], "left_semi")
    return keys.select(GOVT_KEY).distinct().withColumn("govt", F.lit("1"))


def classify(layout: Layout, keys: DataFrame) -> DataFrame:
    """The rows of ``operators.address.classify`` with the given government keys."""
    layout.put_keys(keys.select(GOVT_KEY, F.col("govt").alias("govt_flag")), "govt_keys", GOVT_KEY)
    joined = layout.table("addresses").join(layout.table("govt_keys"), [GOVT_KEY, SALT], "left")
    return joined.selectExpr(*[f"{GOVT_SQL} AS govt" if c == "govt" else c for c in S.ADDRESS_LAYOUT])
