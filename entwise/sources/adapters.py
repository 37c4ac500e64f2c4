"""Driver test tables -> the logical tables the pipelines expect.

The driver ships TPC-H-like tables with no NULLs and no orphans. These recipes
derive the entity-data tables from them with deterministic rules that also
create NULLs, padded codes, sentinel dates, copies and unmapped values;
tests assert that the registered queries return rows that each rule changed. Each recipe is a projection (plus at most one join), so its size
grows with the input. The DuckDB texts in ``plans.oracle`` mirror them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.text import code_map

# Fixture recipe values (our own, not from the source jobs).
EVENT_COLUMN_CODES = {
    "click": "LGL_NM",
    "error": "ERR_CD",          # unmapped -> dropped
    "purchase": "ACT_SLS_SZ",
    "signup": "CHILD_PBIN",     # structural
    "view": " SIC_CD_PRI ",     # blank-padded
}
EXCLUDED_USERS = ["U0"]
LOADED_BEFORE_DAY = "2024-01-11"          # change days already transformed
LOADED_BEFORE_TIME = "2024-01-11 12:00:00"  # a load that ended inside a day
AS_OF = "1998-06-01"                      # the day of the refresh decision
LOADED_BEFORE_SHIPDATE = "1998-01-01"     # supplement reports already loaded
FIXTURE_GOVT_YEARS = ["1998", "1999", "2000", "2001"]
ANALYSIS_ELEMENTS = ["Name", "Emp_Size", "Sls_Size", "AIN", "Phone_AREA", "Phone_PFX", "SIC"]
RC_TYPES = ["F", "G", "H", "P", "R", "S", "X"]
ZIP_STATUS = ["A", "C", "Z", None]
PROBLEM_CODES = ["0", "0", "1", "2", None]
CMRA = ["Y", "N", None, " N "]
RESIDENTIAL = ["Y", "N", None]
PROVINCES = ["San Jose", "Alajuela", "Heredia", "Cartago", "Guanacaste", "Puntarenas", "Limon",
             "Atlantis"]
GENDERS = ["M", "F", "Other", None]


def load(spark: SparkSession, sf_dir: str, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _lit(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _pick(index_sql: str, values: Sequence[str | None]) -> str:
    """SQL: values[index] as a CASE (NULL entries give NULL)."""
    whens = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values))
    return f"CAST(CASE {index_sql} {whens} END AS STRING)"


def _map_sql(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


# both sentinel dates in both columns; some reports occur twice, the second time
# with a blank before the date, which only the cleaning makes equal
REPORT_SQL = [
    "CAST(l_orderkey AS STRING) AS lvid",
    "CAST(l_suppkey AS INT) AS supplier_nb",
    "CASE l_orderkey % 23 WHEN 0 THEN '0401-01-01' WHEN 1 THEN '01/01/0401' "
    "ELSE date_format(date_sub(CAST(l_shipdate AS DATE), 30), 'MM/dd/yyyy') END AS dt_first_rpted",
    "concat(copy, CASE (l_orderkey + l_linenumber) % 29 WHEN 0 THEN '0401-01-01' WHEN 1 THEN '01/01/0401' "
    "ELSE date_format(CAST(l_shipdate AS DATE), 'MM/dd/yyyy') END) AS dt_last_rpted",
]
COPIES_SQL = "explode(CASE WHEN l_orderkey % 31 = 0 THEN array('', ' ') ELSE array('') END) AS copy"


# --- change log -------------------------------------------------------------

def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    after, before = "CAST(floor(value) AS STRING)", "get_json_object(props, '$.k')"
    return ev.selectExpr(
        "CAST(user_id AS STRING) AS pbin",
        "substring(CAST(ts AS STRING), 1, 19) AS trn_ts",   # no time-zone round trip
        "upper(event_type) AS table_nm",
        f"{_map_sql('event_type', EVENT_COLUMN_CODES)} AS column_nm",
        # padded, absent, non-numeric and fractional values; some differ by blanks only
        f"CASE event_id % 11 WHEN 0 THEN concat('00', {after}) WHEN 1 THEN NULL WHEN 2 THEN 'N/A' "
        f"WHEN 3 THEN concat({after}, '.5') ELSE {after} END AS after_value",
        f"CASE event_id % 13 WHEN 0 THEN concat('0', {before}) WHEN 1 THEN NULL "
        f"WHEN 2 THEN concat(' ', {after}, ' ') ELSE {before} END AS before_value",
        "CASE WHEN user_id % 10 = 9 THEN NULL ELSE concat('U', CAST(user_id % 10 AS STRING)) END "
        "AS sbu_user_id",
        "CAST(user_id % 100 AS INT) AS sbu_supplier_nb",
    )


# --- entities and supplier sources -------------------------------------------

def entity_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    # some locations are stored a second time with a padded id, some have none
    lvid = "CAST(o_orderkey AS STRING)"
    lvids = (f"explode(CASE WHEN o_orderkey % 37 = 5 THEN array(CAST(NULL AS STRING)) WHEN o_orderkey % 17 = 0 "
             f"THEN array({lvid}, concat(' ', {lvid}, ' ')) ELSE array({lvid}) END) AS lvid")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.selectExpr(
        "CAST(c_custkey AS STRING) AS pbin",
        "CAST(c_custkey * 10 AS STRING) AS child_pbin",
        lvids,
        "c_mktsegment AS std_usps_nprf_str",
        "concat('CITY', CAST(c_nationkey AS STRING)) AS std_city_nm",
        "lpad(CAST(c_nationkey AS STRING), 2, '0') AS std_state_cd",
        "lpad(CAST(c_nationkey AS STRING), 5, '0') AS std_zip5_cd",
        "CAST(c_custkey AS STRING) AS ain",
        "upper(c_name) AS name_norm_long",
        "c_name AS ol_lgl_nm_long",
    )


def _lineitem_report(spark: SparkSession, sf_dir: str, extra: Sequence[str],
                     shipped_before: str | None = None) -> DataFrame:
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_shipdate", "l_linenumber", *extra])
    if shipped_before:
        # on the raw column, so the scan takes it as a pushed filter
        li = li.filter(F.col("l_shipdate") < F.lit(shipped_before).cast("timestamp_ntz"))
    return li.selectExpr("*", COPIES_SQL)


def sic_source(spark: SparkSession, sf_dir: str, shipped_before: str | None = None) -> DataFrame:
    li = _lineitem_report(spark, sf_dir, ["l_partkey", "l_returnflag"], shipped_before)
    part4 = "lpad(CAST(l_partkey % 10000 AS STRING), 4, '0')"
    supplier = "CASE WHEN l_orderkey % 41 = 7 THEN NULL ELSE supplier_nb END AS supplier_nb"  # some have none
    return li.selectExpr("*", *REPORT_SQL).selectExpr(
        "lvid", supplier, "dt_first_rpted", "dt_last_rpted",
        "l_returnflag AS sic_ty_cd",
        f"{part4} AS sic_cd",
        f"concat(CASE WHEN l_partkey % 5 = 0 THEN '92' ELSE '44' END, {part4}) AS naics_std_cd",
    )


def phone_source(spark: SparkSession, sf_dir: str, shipped_before: str | None = None) -> DataFrame:
    li = _lineitem_report(spark, sf_dir, ["l_partkey"], shipped_before)
    return li.selectExpr(
        *REPORT_SQL,
        "CAST(l_linenumber + 200 AS STRING) AS ph_area_cd",
        "lpad(CAST(l_partkey % 1000 AS STRING), 3, '0') AS ph_nb_pfx",
    )


def size_source(spark: SparkSession, sf_dir: str, shipped_before: str | None = None) -> DataFrame:
    li = _lineitem_report(spark, sf_dir, ["l_quantity", "l_extendedprice", "l_returnflag",
                                          "l_linestatus"], shipped_before)
    cents = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    return li.selectExpr(
        *REPORT_SQL,
        f"CASE WHEN l_orderkey % 13 = 0 THEN 'N/A' ELSE concat(CAST({cents} div 100 AS STRING), '.', "
        f"lpad(CAST({cents} % 100 AS STRING), 2, '0')) END AS act_sls_sz",
        "l_linestatus AS emp_sls_sz_ty_cd",
        "CAST(floor(l_quantity) AS STRING) AS act_emp_sz",
        "l_returnflag AS sls_sz_cd",
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with an odd number; reports of the others have no name."""
    s = load(spark, sf_dir, "supplier", ["s_suppkey", "s_name"]).filter("s_suppkey % 2 = 1")
    return s.selectExpr("CAST(s_suppkey AS INT) AS supplier_nb", "s_name AS supplier_nm")


def loaded_supplement(spark: SparkSession, sf_dir: str, parts=None) -> DataFrame:
    """Supplement keys an earlier load stored: the given elements as reported
    before LOADED_BEFORE_SHIPDATE. ``parts`` lists (source adapter, specs) as
    the build uses them (default: every element); each source is scanned once.
    Only the anti-join keys matter."""
    from entwise.operators import supplement as sup
    if parts is None:
        parts = [(sic_source, [sup.SIC]), (phone_source, [sup.PHONE_AREA, sup.PHONE_PFX]),
                 (size_source, [sup.SLS_SIZE, sup.EMP_SIZE])]
    out = None
    for fn, specs in parts:
        long = sup.unpivot_elements(fn(spark, sf_dir, shipped_before=LOADED_BEFORE_SHIPDATE), specs)
        out = long if out is None else out.unionByName(long)
    return out


# --- addresses and locations -------------------------------------------------

def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = "CAST(c_nationkey AS STRING)"
    has_unit = "c_custkey % 3 <> 0"
    derived = {
        "ain": "CAST(c_custkey AS STRING)",
        "std_addr_hsh_nb": "CAST(c_custkey * 7919 AS STRING)",
        "std_hse_nb": "CAST(c_custkey AS STRING)",
        "std_str_addr": "c_mktsegment",
        "std_str_sfx": "'ST'",
        "std_pre_direction": "CASE WHEN c_custkey % 4 = 1 THEN 'N' END",
        "std_pst_direction": "CASE WHEN c_custkey % 6 = 2 THEN 'SW' END",
        "std_zip4_cd": "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')",
        "std_zip5_cd": f"lpad({nation}, 5, '0')",
        "std_unit_ty_cd": f"CASE WHEN {has_unit} THEN 'STE' END",
        "std_unit_nb": f"CASE WHEN {has_unit} THEN CAST(c_custkey % 50 AS STRING) END",
        "std_state_cd": f"lpad({nation}, 2, '0')",
        "std_city_nm": f"concat('CITY', {nation})",
        "std_rtn_cd": "CASE WHEN c_custkey % 11 = 0 THEN 'R' END",
        "std_usps_rc_ty_cd": _pick("c_custkey % 7", RC_TYPES),
        "std_zip_cd_stat_cd": _pick("c_custkey % 4", ZIP_STATUS),
        "std_ovall_prbl_cor": _pick("c_custkey % 5", PROBLEM_CODES),
        "std_usps_nprf_city": f"concat('CITY', {nation})",
        "std_usps_nprf_str": "c_mktsegment",
        "hyg_cmra_in": _pick("(c_custkey div 3) % 4", CMRA),
        "hyg_residential_in": _pick("(c_custkey div 9) % 3", RESIDENTIAL),
    }
    return c.selectExpr(*[f"CAST({derived.get(n, 'NULL')} AS STRING) AS {n}"
                          for n in S.ADDRESS_INPUT_COLUMNS])


def location_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.selectExpr("CAST(o_custkey AS STRING) AS ain", "CAST(o_orderkey AS STRING) AS lvid")


def entity_location_assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.selectExpr("CAST(o_orderkey AS STRING) AS lvid", "CAST(o_custkey AS STRING) AS pbin")


def operating_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return c.selectExpr("CAST(c_custkey AS STRING) AS pbin", "c_mktsegment AS ol_activity_ind")


# --- dashboard extracts --------------------------------------------------------

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped change rows with the event id as transaction id; strChange is a
    test stand-in: 1 for structural attributes, else 0."""
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    code = code_map("event_type", EVENT_COLUMN_CODES, None)
    name = code_map(F.trim(code), S.CHANGE_CODE_MAP, S.UNMAPPED_CODE)
    return (ev.select(F.col("event_id").alias("transactionID"), name.alias("COLUMN_NM"),
                      (F.col("user_id") % 100).alias("SUPPLIER_NB"))
            .filter(F.col("COLUMN_NM") != F.lit(S.UNMAPPED_CODE))
            .withColumn("strChange", F.when(F.col("COLUMN_NM").isin(*S.STRUCTURAL_COLUMNS),
                                            F.lit(1.0)).otherwise(F.lit(0.0))))


def structural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structural change rows keyed by entity (pbin as a number)."""
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "ts"])
    structural_events = [k for k, v in EVENT_COLUMN_CODES.items()
                         if S.CHANGE_CODE_MAP.get(v.strip()) in S.STRUCTURAL_COLUMNS]
    return (ev.filter(F.col("event_type").isin(*structural_events))
            .select(F.col("user_id").alias("pbin"), F.col("event_id").alias("transactionID"),
                    F.col("ts").cast("date").cast("string").alias("trn_day")))


def analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_discount",
                                          "l_tax"])
    s = load(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    j = li.join(s, li.l_suppkey == s.s_suppkey, "inner")
    return j.selectExpr(
        "l_orderkey AS PBIN",
        "s_name AS SUPPLIER_NM",
        f"{_pick('l_linenumber - 1', ANALYSIS_ELEMENTS)} AS COLUMN_NM",
        "l_discount AS pRatio",
        "l_tax AS tsoRatio",
    )


def survey_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form answers, one respondent per customer; some provinces are not
    options, some genders are missing and some ages have no row."""
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                         "c_mktsegment"])
    answers = [
        ("name", "c_name"),
        ("food", "lower(c_mktsegment)"),
        ("hobbie", "CASE WHEN c_custkey % 7 = 3 THEN ' ' ELSE 'reading' END"),
        ("age", "CAST(floor(abs(c_acctbal) / 100) AS STRING)"),
        ("province", _pick("c_nationkey % 8", PROVINCES)),
        ("gender", _pick("c_custkey % 4", GENDERS)),
    ]
    stack = ", ".join(f"'{i}', CAST({v} AS STRING)" for i, v in answers)
    return c.selectExpr("c_custkey AS respondent_id",
                        f"stack({len(answers)}, {stack}) AS (input_id, answer)") \
        .filter("NOT (respondent_id % 10 = 4 AND input_id = 'age')")


# --- refresh control -----------------------------------------------------------

def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control row for each customer; some tables are never refreshed."""
    c = load(spark, sf_dir, "customer", ["c_custkey"])
    return c.selectExpr(
        "concat('table_', c_custkey) AS table", "concat('/src/', c_custkey) AS source",
        "concat('db.t', c_custkey) AS destination",
        "date_format(date_add(DATE '1996-01-01', CAST(c_custkey * 37 % 1000 AS INT)), 'yyyyMMdd') AS last_update",
        "CAST(c_custkey % 5 * 30 AS INT) AS update_freq")


def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each order under its customer's source, some with other names."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.selectExpr("concat('/src/', o_custkey) AS source",
                        "CASE WHEN o_orderkey % 7 = 0 THEN concat('tmp_', o_orderkey) "
                        "ELSE date_format(CAST(o_orderdate AS DATE), 'yyyyMMdd') END AS snapshot")
