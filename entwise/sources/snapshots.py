"""Dated snapshot folders and the control table that says when to reload them.

A source root holds one folder per snapshot, named ``yyyyMMdd``. The control
table has one row per target table: (table, source, destination, last_update
'yyyyMMdd', update_freq days). All of this is control-plane data, one row per
table or per folder; the data loads themselves are Spark jobs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S

CONTROL_JSON_TYPE = ("map<string, struct<destination: string, last_update: string, "
                     "source: string, update_freq: int>>")
SNAPSHOT_PATTERN = r"^[0-9]{8}$"
DEFAULT_ZONE = "America/Chicago"


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the direct sub-folders of ``root`` (one listing call through the
    Hadoop FileSystem API, which serves HDFS, object stores and local paths)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]


def snapshot_folders(spark: SparkSession, roots: Iterable[str]) -> DataFrame:
    """(source, snapshot) for every sub-folder of every root."""
    rows = [(r, name) for r in roots for name in list_folders(spark, r)]
    return spark.createDataFrame(rows, "source string, snapshot string")


def latest(folders: DataFrame) -> DataFrame:
    """(source, latest) — the newest 8-digit folder per source. Names that are
    not 8 digits are ignored (they could not be parsed as dates)."""
    return (folders.filter(F.col("snapshot").rlike(SNAPSHOT_PATTERN))
            .groupBy("source").agg(F.max("snapshot").alias("latest")))


VERSION_PATTERN = r"v[0-9]{8}"


def control_versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of the control file under ``path``, oldest first."""
    names = sorted(n for n in list_folders(spark, path) if re.fullmatch(VERSION_PATTERN, n))
    jvm = spark.sparkContext._jvm
    done = []
    for n in names:
        mark = jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")
        if mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
            done.append(n)
    return done


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Control file (one JSON object: table -> {source, destination, last_update,
    update_freq}) as a DataFrame with ``CONTROL_SCHEMA``. If ``path`` holds
    versions that ``write_control`` wrote, the newest complete one counts."""
    versions = control_versions(spark, path)
    doc = spark.read.option("wholetext", True).text(f"{path}/{versions[-1]}" if versions else path)
    entries = doc.select(F.explode(F.from_json("value", CONTROL_JSON_TYPE)).alias("table", "info"))
    return entries.select(F.col("table"), *[F.col(f"info.{c}").alias(c) for c in
                                            ("source", "destination", "last_update", "update_freq")])


def today_in(zone: str = DEFAULT_ZONE) -> Column:
    """Today's date in ``zone``, whatever the session's time zone."""
    return day_in(F.current_timestamp(), zone)


def day_in(moment: Column, zone: str) -> Column:
    """The date on which ``moment`` (a timestamp) falls in ``zone``: read as wall-
    clock time of the session's zone and converted from there once."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), moment.cast("timestamp_ntz")))


def refresh_plan(control: DataFrame, latest_snapshots: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Decide per table: ``not_needed``, ``update`` or ``failed``.

    due date = last_update + update_freq days. No update when update_freq is 0
    or the due date is on/after ``as_of`` (default: today in US Central time).
    Otherwise the latest snapshot must be newer than last_update, else the
    table fails ('no newer source'). ``note`` says 'older_than_expected' when
    the snapshot used predates the due date.
    """
    if as_of is None:
        as_of_c = today_in()
    elif isinstance(as_of, str):
        as_of_c = F.to_date(F.lit(as_of))
    else:
        as_of_c = as_of
    last = F.to_date(F.col("last_update"), "yyyyMMdd")
    due = F.date_add(last, F.col("update_freq"))
    snap = F.col("latest")
    snap_date = F.to_date(snap, "yyyyMMdd")
    plan = control.join(latest_snapshots, "source", "left")
    status = (F.when((F.col("update_freq") == 0) | (due >= as_of_c), F.lit("not_needed"))
              .when(snap.isNull(), F.lit("failed"))
              .when(snap > F.col("last_update"), F.lit("update"))
              .otherwise(F.lit("failed")))
    note = (F.when(status == "failed",
                   F.when(snap.isNull(), F.lit("no source folder")).otherwise(F.lit("no newer source")))
            .when((status == "update") & (due > snap_date), F.lit("older_than_expected")))
    return plan.select("table", "source", "destination", "last_update", "update_freq",
                       due.alias("due"), snap.alias("snapshot"), status.alias("status"),
                       note.alias("note"))


def advance_control(control: DataFrame, loaded: DataFrame) -> DataFrame:
    """Control rows with ``last_update`` set to the snapshot just loaded, for the
    tables in ``loaded`` (table, snapshot)."""
    return (control.join(loaded.select("table", F.col("snapshot").alias("_new")), "table", "left")
            .withColumn("last_update", F.coalesce(F.col("_new"), F.col("last_update")))
            .drop("_new").select(*S.CONTROL_SCHEMA.fieldNames()))


def write_control(control: DataFrame, path: str) -> str:
    """Write the control rows as one JSON object with sorted keys, in a new
    version folder under ``path``; nothing is deleted or overwritten. Readers take
    the newest version whose job has finished, so a crash leaves the last one."""
    spark = control.sparkSession
    names = [n for n in list_folders(spark, path) if re.fullmatch(VERSION_PATTERN, n)]
    out = f"{path}/v{max((int(n[1:]) for n in names), default=0) + 1:08d}"
    info = F.struct(*[F.col(c) for c in ("destination", "last_update", "source", "update_freq")])
    doc = control.agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct(F.col("table"), info))))).alias("value"))
    doc.write.text(out)
    return out


def report(plan: DataFrame) -> DataFrame:
    """(status, tables) — the updated / not needed / failed lists."""
    return plan.groupBy("status").agg(F.array_sort(F.collect_list("table")).alias("tables"))
