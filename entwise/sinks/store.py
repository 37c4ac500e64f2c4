"""Tables that change by one switch.

A store is a folder with tables cut into parts (a day, a load). A change writes
the new files of all its parts aside, in folders of their own, and then one
manifest, a new version of the list of parts: (table, part, folder). Readers take
the newest version whose write has finished, so they see all of a change or
nothing of it, over any number of tables; a crash in between leaves files that no
manifest names. A change that is made again replaces the same parts.

The manifest holds one row for each part and is the only thing the driver reads.
Files carry all columns, the part's too. Nothing is deleted.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entwise.sources.snapshots import list_folders

VERSION = r"v[0-9]{8}"
MANIFEST = "table string, part string, folder string"
_PART = "_part"


class Conflict(ValueError):
    """Another change was committed since this one read the store."""


class Store:
    """The tables under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- what is there -------------------------------------------------------

    def version(self) -> int:
        """Number of the newest complete manifest, 0 if there is none."""
        jvm, done = self.spark.sparkContext._jvm, 0
        for name in list_folders(self.spark, f"{self.root}/manifests"):
            if re.fullmatch(VERSION, name):
                mark = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/{name}/_SUCCESS")
                if mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
                    done = max(done, int(name[1:]))
        return done

    def manifest(self, version: int | None = None) -> dict[tuple[str, str], str]:
        """(table, part) -> folder, in the given version or the newest."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifests/v{version:08d}")
        return {(r.table, r.part): r.folder for r in rows.collect()}

    def read(self, table: str, schema: T.StructType | str, parts: Iterable[str] | None = None,
             version: int | None = None) -> DataFrame:
        """A table's rows, of the given parts alone if any are named: files of
        other parts aren't listed. An unknown table or part has no rows."""
        wanted = None if parts is None else set(parts)
        folders = sorted(f for (t, p), f in self.manifest(version).items() if t == table and (wanted is None or p in wanted))
        return self.files(folders, schema)

    def files(self, folders: Iterable[str], schema: T.StructType | str) -> DataFrame:
        """Rows of staged or committed folders."""
        paths = [f"{self.root}/{f}" for f in sorted(folders)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # --- changes ---------------------------------------------------------------

    def stage(self, df: DataFrame, by: str | None = None, part: str | None = None) -> dict[str, str]:
        """Write ``df`` aside, one part for each value of column ``by`` (rows where
        it is NULL or empty are left out), or as the one part ``part``. Returns part -> folder. One job; the parts
        are read from the folders it wrote, ``df`` is not computed again."""
        folder = f"data/{uuid.uuid4().hex}"
        if by is None:
            df.write.parquet(f"{self.root}/{folder}")
            return {part or "": folder}
        kept = df.withColumn(_PART, F.col(by).cast("string")).filter(F.col(_PART) != "")
        kept.write.partitionBy(_PART).parquet(f"{self.root}/{folder}")
        found = [x for x in list_folders(self.spark, f"{self.root}/{folder}") if x.startswith(f"{_PART}=")]
        return {unquote(x.split("=", 1)[1]): f"{folder}/{x}" for x in found}

    def commit(self, changes: Mapping[str, Mapping[str, str | None]], whole: Iterable[str] = (),
               since: int | None = None) -> int:
        """Switch to the next version: for each table the given parts are replaced
        (None removes one); tables in ``whole`` keep no other part. With ``since``,
        the version that the change was computed from, a commit made by another in
        the meantime raises ``Conflict``. Returns the new version."""
        now = self.version()
        if since is not None and now != since:
            raise Conflict(f"version {now} was committed after {since}")
        whole = set(whole)
        parts = {k: f for k, f in self.manifest(now).items() if k[0] not in whole}
        for table, new in changes.items():
            for part, folder in new.items():
                if folder is None:
                    parts.pop((table, part), None)
                else:
                    parts[table, part] = folder
        names = [int(x[1:]) for x in list_folders(self.spark, f"{self.root}/manifests") if re.fullmatch(VERSION, x)]
        version = max([now, *names]) + 1  # a write that broke off keeps its number
        rows = self.spark.createDataFrame([(t, p, f) for (t, p), f in sorted(parts.items())], MANIFEST)
        rows.coalesce(1).write.json(f"{self.root}/manifests/v{version:08d}")
        return version

    # --- whole operations --------------------------------------------------------

    def overwrite(self, df: DataFrame, table: str) -> int:
        """Replace a table. ``df`` may read the table itself."""
        return self.commit({table: self.stage(df)}, whole=[table])

    def append(self, df: DataFrame, table: str, load: str) -> int:
        """Add the rows of a load, named ``load``; the same load again replaces its
        rows instead of adding them twice."""
        return self.append_all({table: df}, load)

    def append_all(self, tables: Mapping[str, DataFrame], load: str) -> int:
        """Add a load's rows to several tables at once."""
        return self.commit({t: self.stage(df, part=load) for t, df in tables.items()})

    def replace_parts(self, df: DataFrame, table: str, by: str, parts: Iterable[str]) -> int:
        """Replace the parts ``parts`` of a table that is cut by column ``by``; those
        without rows in ``df`` vanish. Rows of other parts are an error."""
        staged, parts = self.stage(df, by), set(parts)
        if not set(staged) <= parts:
            raise ValueError(f"rows of other parts: {sorted(set(staged) - parts)}")
        return self.commit({table: {p: staged.get(p) for p in parts}})
