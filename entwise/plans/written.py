"""Registered queries that write and read back: loads, appends, replacements, CSV
files, snapshots, layouts. Each works in a scratch folder of its own, on tables
that the adapters derive from the driver's."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise import sinks
from entwise.operators import change_state, metrics, survey, views
from entwise.operators import supplement as sup
from entwise.plans import jobs, layout
from entwise.plans.catalog import PAGE_AFTER, _normalized, _refresh_plan, _supplement
from entwise.sinks.store import Store
from entwise.sources import adapters as A
from entwise.sources import snapshots as snap
from entwise.sources.csv import csv_lines, csv_snapshot
from entwise.sources.registry import Registry
from entwise.sources.scratch import scratch
from entwise.streaming.change_stream import start_change_stream_into

Query = Callable[[SparkSession, str], DataFrame]

# Fixture values (our own): a day and an hour at which loads are cut, and the days reloaded.
CUT_TIMES = ("2024-01-08 18:00:00", "2024-01-16 06:00:00")
RELOADED_FROM = "2024-01-15"
SNAPSHOTS = {"nation": "20240301", "supplier": "20240301", "customer": "20240301", "part": "20240301", "region": "20240101"}
BROKEN = "part"           # its newest folder holds no data
DRIFTED = "customer"      # its newest snapshot has other columns
LAYOUT_SQL = "PBIN long, SUPPLIER_NM string, COLUMN_NM string, pRatio double, tsoRatio double"


def _store(spark: SparkSession, name: str) -> Store:
    return Store(spark, scratch(spark, name))


# --- tables that change by one switch --------------------------------------------

def changes_loaded_in_cuts(spark, d):
    """Three loads, cut inside days, out of order, one made twice."""
    raw, store = A.raw_changes(spark, d), _store(spark, "changes")
    early, late = CUT_TIMES
    parts = {"early": raw.filter(raw.trn_ts < early), "middle": raw.filter((raw.trn_ts >= early) & (raw.trn_ts < late)),
             "late": raw.filter(raw.trn_ts >= late)}
    for name in ("late", "early", "middle", "late"):
        change_state.load_changes(store, parts[name], name, A.EXCLUDED_USERS)
    return change_state.changes(store)


def changes_streamed(spark, d):
    """The raw log as files, streamed one file at a time, and once more from the start."""
    root = scratch(spark, "stream")
    A.raw_changes(spark, d).repartitionByRange(4, "sbu_supplier_nb").write.parquet(f"{root}/raw")
    for run in ("first", "again"):
        start_change_stream_into(spark, f"{root}/raw", f"{root}/store", f"{root}/{run}", A.EXCLUDED_USERS,
                                 files_per_batch=2).awaitTermination()
    return change_state.changes(Store(spark, f"{root}/store"))


def table_overwritten(spark, d):
    """A table replaced by the rows computed from it."""
    store, names = _store(spark, "overwrite"), A.suppliers(spark, d)
    store.overwrite(names, "suppliers")
    old = store.read("suppliers", S.SUPPLIERS_SCHEMA)
    store.overwrite(old.selectExpr("supplier_nb", "upper(supplier_nm) AS supplier_nm"), "suppliers")
    return store.read("suppliers", S.SUPPLIERS_SCHEMA)


def table_appended(spark, d):
    """Two supplement loads appended, one of them twice."""
    store = _store(spark, "append")
    loads = {"sic": (A.sic_source, [sup.SIC]), "area": (A.phone_source, [sup.PHONE_AREA])}
    for name in ("sic", "area", "sic"):
        store.append(_supplement(spark, d, [loads[name]]), "supplement", name)
    return store.read("supplement", S.SUPPLEMENT_SCHEMA)


def table_days_replaced(spark, d):
    """A change table cut by days, the days from RELOADED_FROM on reloaded with name changes only."""
    store, rows = _store(spark, "days"), _normalized(spark, d)
    store.commit({"changes": store.stage(rows, by="trn_ts")})
    days = [p for t, p in store.manifest() if p >= RELOADED_FROM]
    fresh = store.read("changes", S.CHANGES_SCHEMA, days).filter("column_nm = 'Name'")
    store.replace_parts(fresh, "changes", "trn_ts", days)
    return store.read("changes", S.CHANGES_SCHEMA).select(*S.CHANGES_LAYOUT)


def _survey_store(spark, d):
    store, answers = _store(spark, "survey"), A.survey_responses(spark, d)
    for name, part in (("even", 0), ("odd", 1), ("even", 0)):   # a batch that runs again
        jobs.load_survey_once(store, answers.filter(F.pmod("respondent_id", F.lit(2)) == part), name)
    return store, answers.schema, survey.invalid_responses(spark, answers).schema


def survey_loaded(spark, d):
    store, kind, _ = _survey_store(spark, d)
    return store.read("accepted", kind)


def survey_loaded_invalid(spark, d):
    store, _, kind = _survey_store(spark, d)
    return store.read("invalid", kind)


# --- CSV ---------------------------------------------------------------------------

def csv_round_trip(spark, d):
    """Exported, and read back with inferred types."""
    path = scratch(spark, "csv")
    sinks.export_csv(A.analysis(spark, d), path)
    return csv_snapshot(spark, path).selectExpr("CAST(PBIN AS BIGINT) AS PBIN", "SUPPLIER_NM", "COLUMN_NM", "pRatio", "tsoRatio")


def csv_with_schema(spark, d):
    path = scratch(spark, "csv")
    sinks.export_csv(A.analysis(spark, d), path)
    return csv_snapshot(spark, path, spark.createDataFrame([], LAYOUT_SQL).schema)


def _ragged(spark, d):
    """Transactions as lines: some lack their last fields, some have one or two more,
    some quote a name with a comma and a quote in it."""
    path = scratch(spark, "ragged")
    name = ("CASE WHEN transactionID % 5 = 0 THEN concat('\"', COLUMN_NM, ', \"\"x\"\"\"') "
            "ELSE coalesce(COLUMN_NM, '') END")
    tail = ("CASE WHEN transactionID % 7 = 0 THEN '' WHEN transactionID % 7 = 1 THEN concat(',', SUPPLIER_NB) "
            "ELSE concat(',', SUPPLIER_NB, ',', CAST(strChange AS INT), CASE transactionID % 11 WHEN 0 THEN ',more' "
            "WHEN 1 THEN ',more,\"a,b\"' ELSE '' END) END")
    lines = A.transactions(spark, d).selectExpr(f"concat(transactionID, ',', {name}, {tail}) AS value")
    # every file begins with the header
    head = spark.range(4).selectExpr("'transactionID,COLUMN_NM,SUPPLIER_NB,strChange' AS value", "CAST(id AS INT) AS part", "0 AS nth")
    rows = lines.selectExpr("value", "CAST(pmod(xxhash64(value), 4) AS INT) AS part", "1 AS nth")
    head.unionAll(rows).repartition(4, "part").sortWithinPartitions("nth").select("value").write.text(path)
    return csv_lines(spark, path)


def ragged_read(spark, d):
    return _ragged(spark, d).select("transactionID", "COLUMN_NM", "SUPPLIER_NB", "strChange",
                                    F.array_join("_extra", "|").alias("extra"))


def ragged_pivot(spark, d):
    rows = _ragged(spark, d).filter("SUPPLIER_NB IS NOT NULL").selectExpr("CAST(SUPPLIER_NB AS INT) AS SUPPLIER_NB", "COLUMN_NM")
    return views.pivot(rows, ["SUPPLIER_NB"], "COLUMN_NM", ["Name", "SIC", "Sls_Size"], "count")


# --- snapshots ---------------------------------------------------------------------

def _snapshot_folders(spark, d, root):
    """A first and a newest snapshot of each table as CSV folders, and the control file."""
    for table, day in SNAPSHOTS.items():
        rows = A.load(spark, d, table)
        sinks.export_csv(rows, f"{root}/{table}/20240101")
        if table == BROKEN:
            spark.createDataFrame([], "value string").write.text(f"{root}/{table}/{day}")
        elif day != "20240101":
            if table == DRIFTED:
                rows = rows.drop("c_mktsegment").withColumns({
                    "c_added": F.lit("new"), "c_acctbal": F.concat(F.lit("USD "), F.col("c_acctbal").cast("string"))})
            sinks.export_csv(rows, f"{root}/{table}/{day}")
    prefix = f"ew_{uuid.uuid4().hex[:12]}_"
    control = spark.createDataFrame([(t, f"{root}/{t}", f"{prefix}{t}", "20240101", 7) for t in SNAPSHOTS], S.CONTROL_SCHEMA)
    snap.write_control(control, f"{root}/control")
    registry = Registry(spark, f"{root}/schemas")
    for t in SNAPSHOTS:
        registry.read(t, f"{root}/{t}/20240101")
    return prefix, registry


def snapshots_refreshed(spark, d):
    """The run report after a refresh in which one snapshot can't be read and one
    drifted: a row for each table with its rows loaded."""
    root = scratch(spark, "snapshots")
    prefix, registry = _snapshot_folders(spark, d, root)
    plan, _ = jobs.refresh_snapshots(spark, f"{root}/control", f"{root}/control", "2024-03-05", registry=registry,
                                     report_path=f"{root}/report")
    counts = [(r["table"], spark.table(r["destination"]).count()) for r in plan.collect() if r["status"] == "update"]
    report = spark.read.schema("status string, tables array<string>").json(f"{root}/report") \
        .select("status", F.explode("tables").alias("table"))
    control = snap.read_control(spark, f"{root}/control").select("table", "last_update")
    return report.join(spark.createDataFrame(counts, "table string, rows long"), "table", "left").join(control, "table") \
        .select("table", "status", "last_update", "rows")


def snapshot_drift(spark, d):
    """What the drifted snapshot reports, a row for each column."""
    root = scratch(spark, "drift")
    _, registry = _snapshot_folders(spark, d, root)
    return registry.read(DRIFTED, f"{root}/{DRIFTED}/{SNAPSHOTS[DRIFTED]}")[1]


def run_report(spark, d):
    """The lists of updated, not needed and failed tables, as text."""
    return snap.report(_refresh_plan(spark, d)).select("status", F.size("tables").cast("long").alias("n"),
                                                       F.array_join("tables", ",").alias("tables"))


# --- layouts -------------------------------------------------------------------------

def _layout(spark, d) -> layout.Layout:
    out = layout.Layout(spark, f"ew_{uuid.uuid4().hex[:12]}_", scratch(spark, "layout"),
                        int(spark.conf.get("spark.sql.shuffle.partitions")))
    layout.store(out, A.address(spark, d), A.location_addresses(spark, d), A.sic_source(spark, d),
                 A.entity_location_assoc(spark, d), A.operating_locations(spark, d), years=A.FIXTURE_GOVT_YEARS)
    return out


def government_keys_bucketed(spark, d):
    return layout.government_keys(_layout(spark, d))


def address_classified_bucketed(spark, d):
    stored = _layout(spark, d)
    return layout.classify(stored, layout.government_keys(stored))


def page_clustered_next(spark, d):
    """A page some way into the table, from the files that hold it."""
    path = scratch(spark, "clustered")
    views.write_clustered(A.analysis(spark, d), path, "pRatio", ascending=False, rows_per_file=4096)
    return views.page_clustered(spark, path, "pRatio", ascending=False, size=25, after=PAGE_AFTER)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    changes_loaded_in_cuts, changes_streamed, table_overwritten, table_appended, table_days_replaced, survey_loaded,
    survey_loaded_invalid, csv_round_trip, csv_with_schema, ragged_read, ragged_pivot, snapshots_refreshed, snapshot_drift,
    run_report, government_keys_bucketed, address_classified_bucketed, page_clustered_next)}
QUERIES["histogram_round"] = lambda s, d: metrics.histogram_round(A.structural(s, d), "pbin", 50)
