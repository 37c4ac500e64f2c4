"""End-to-end jobs: read tables, run an operator, write the result.

Each job is one write (one Spark job plus whatever AQE adds); step counts are
collected with ``observe`` during that write instead of extra ``count`` jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise import sinks
from entwise.functions.text import day_of
from entwise.operators import address as addr
from entwise.operators import changes as chg
from entwise.operators import supplement as sup
from entwise.operators import survey
from entwise.operators.quality import AUDITED_FLAGS
from entwise.sinks.store import Store
from entwise.sources import snapshots as snap
from entwise.sources.csv import csv_snapshot
from entwise.sources.registry import Registry


class DriftedSnapshot(ValueError):
    """A snapshot whose columns are not those stored for its table."""


def normalize_changes(spark: SparkSession, batch: DataFrame, raw: DataFrame, changes_table: str,
                      excluded_users: Sequence[str]) -> list[str]:
    """Load the change rows of every day that ``batch`` touches into
    ``changes_table`` (partitioned by ``trn_ts``), computed from the whole raw log
    ``raw``, the batch included. Any way to cut the log into loads, and a load
    that runs again, gives the same table. Returns the days (a load's own). The
    log is scanned from the first of these days to the last, by a pushed filter;
    ``operators.change_state`` reads no raw log at all."""
    day = batch.select(day_of("trn_ts").alias("day")).filter("day IS NOT NULL")
    days = sorted(r.day for r in day.distinct().collect())
    if days:
        span = (F.col("trn_ts") >= days[0]) & (F.col("trn_ts") < days[-1] + "\uffff")
        out = chg.normalize(raw.filter(span & day_of("trn_ts").isin(*days)), excluded_users)
        sinks.replace_partitions(out, changes_table, "trn_ts", days)
    return days


def build_supplement(spark: SparkSession, changes_table: str, entity_locations_table: str,
                     suppliers_table: str, sources: Sequence[tuple[str, Sequence[sup.ElementSpec]]],
                     supplement_table: str) -> dict:
    """Append supplement rows for all (source table, specs) in one pass."""
    srcs = [(spark.table(t), specs) for t, specs in sources]
    out = sup.build(spark.table(changes_table), spark.table(entity_locations_table),
                    spark.table(suppliers_table), srcs, loaded=spark.table(supplement_table))
    obs = Observation("build_supplement")
    sinks.append_by_name(out.observe(obs, F.count(F.lit(1)).alias("rows")), supplement_table)
    return obs.get


def build_government_keys(spark: SparkSession, address_table: str, location_addresses_table: str,
                          naics_table: str, assoc_table: str, operating_table: str,
                          govt_table: str, **rule) -> None:
    """Replace the government key table (truncate + reload as one overwrite)."""
    keys = addr.government_keys(spark.table(address_table), spark.table(location_addresses_table),
                                spark.table(naics_table), spark.table(assoc_table),
                                spark.table(operating_table), **rule)
    sinks.replace_rows(keys, govt_table)
    # the classification joins on the key and relies on this
    twice = spark.table(govt_table).groupBy(addr.GOVT_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if twice.limit(1).count():
        raise ValueError(f"{govt_table} holds a key twice")


def classify_addresses(spark: SparkSession, address_table: str, govt_table: str,
                       target_table: str) -> dict:
    """Replace the classified address table; return the flag audit counts,
    gathered during the write."""
    out = addr.classify(spark.table(address_table), spark.table(govt_table))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in AUDITED_FLAGS:
        aggs += [F.count_if(F.col(f) == "1").alias(f"{f}_ones"),
                 F.count_if(F.col(f) == "0").alias(f"{f}_zeros")]
    obs = Observation("classify_addresses")
    sinks.replace_rows(out.observe(obs, *aggs), target_table)
    return obs.get


def refresh_snapshots(spark: SparkSession, control_path: str, new_control_path: str,
                      as_of: str | None = None, schemas: dict | None = None, registry: Registry | None = None,
                      report_path: str | None = None, at_once: int = 4) -> tuple[DataFrame, DataFrame]:
    """Reload every due table from its newest snapshot folder.

    The plan is computed once. The tables marked 'update' (control rows, one per
    table) are loaded by independent jobs, ``at_once`` of them submitted together,
    so a slow or broken one does not hold up the others: a load that fails is
    recorded as 'failed' with the kind of error as its note, and the run goes on.
    After every successful load a new version of the control file is written, so
    neither a failure nor a crash forgets finished loads.

    With ``registry``, snapshots are read with the stored schema of their table,
    and one that drifted from it is recorded as failed and not loaded. Returns the
    plan with the status per table, and the run report: the lists of updated, not
    needed and failed tables, written to ``report_path`` too if that is given.
    """
    rows = snap.read_control(spark, control_path).collect()  # control file: one row per table
    control = spark.createDataFrame(rows, S.CONTROL_SCHEMA)
    latest = snap.latest(snap.snapshot_folders(spark, sorted({r["source"] for r in rows})))
    decided = snap.refresh_plan(control, latest, as_of)
    plan_rows, schema = decided.collect(), decided.schema

    def load(r) -> None:
        path = f"{r['source'].rstrip('/')}/{r['snapshot']}"
        if registry is None:
            df = csv_snapshot(spark, path, (schemas or {}).get(r["table"]))
        else:
            df, drift = registry.read(r["table"], path)
            if changed := drift.collect():  # a row for each column at most
                raise DriftedSnapshot(", ".join(f"{x.column} {x.change}" for x in sorted(changed)))
        sinks.overwrite(df, r["destination"])

    loaded, failed = [], {}
    with ThreadPoolExecutor(at_once) as pool:
        running = {pool.submit(load, r): r for r in plan_rows if r["status"] == "update"}
        for job in as_completed(running):
            r = running[job]
            if error := job.exception():
                failed[r["table"]] = f"drifted: {error}" if isinstance(error, DriftedSnapshot) else f"load failed: {type(error).__name__}"
                continue
            loaded.append((r["table"], r["snapshot"]))
            done = spark.createDataFrame(loaded, "table string, snapshot string")
            snap.write_control(snap.advance_control(control, done), new_control_path)
    plan = spark.createDataFrame([
        {**r.asDict(), "status": "failed", "note": failed[r["table"]]} if r["table"] in failed else r.asDict()
        for r in plan_rows], schema)
    report = snap.report(plan)
    if report_path:
        report.coalesce(1).write.json(report_path)
    return plan, report


def load_survey(spark: SparkSession, responses_table: str, accepted_table: str, invalid_table: str) -> None:
    """Append the responses that pass the survey's checks to ``accepted_table`` and
    the problems of the others to ``invalid_table``; both are created if absent.
    Running it twice appends twice; ``load_survey_once`` does not."""
    accepted, invalid = survey.load_responses(spark, spark.table(responses_table))
    sinks.append_or_create(invalid, invalid_table)
    sinks.append_or_create(accepted, accepted_table)


def load_survey_once(store: Store, responses: DataFrame, load: str) -> int:
    """Add a batch of responses, named ``load``, to the store's tables ``accepted``
    and ``invalid`` with one switch for both. The store's manifest is the ledger of
    loads: a batch that runs again, or again after a crash, is there once."""
    accepted, invalid = survey.load_responses(store.spark, responses)
    return store.append_all({"accepted": accepted, "invalid": invalid}, load)
