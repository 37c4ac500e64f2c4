"""Layouts, code domains and other values that must equal the source jobs' own.

Everything below the FIXED VALUES marker is data, not logic: column orders of
the target tables, code maps, element names and display labels.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original jobs for identical results)
# ---------------------------------------------------------------------------

# Change-log column codes -> attribute names. Codes not listed map to "1"
# (the "unmapped" marker that is filtered out afterwards).
CHANGE_CODE_MAP = {
    "LGL_NM": "Name",
    "PRI_AIN": "AIN",
    "SIC_CD_PRI": "SIC",
    "ACT_EMP_SZ": "Emp_Size",
    "ACT_SLS_SZ": "Sls_Size",
    "PRI_PH_NB_PFX": "Phone_PFX",
    "PRI_PH_NB_SFX": "Phone_SFX",
    "PRI_PH_AREA": "Phone_AREA",
    "CHILD_PBIN": "CHILD_PBIN",
    "PARENT_PBIN": "PARENT_PBIN",
    "PBIN": "PBIN",
    "HQ_BRANCH_CD": "HQ_BRANCH_CD",
}
UNMAPPED_CODE = "1"

# Attributes that describe entity structure rather than content.
STRUCTURAL_COLUMNS = ["CHILD_PBIN", "PARENT_PBIN", "PBIN", "HQ_BRANCH_CD"]

# Supplement element names.
ELEMENT_SIC = "SIC"
ELEMENT_PHONE_AREA = "Phone_AREA"
ELEMENT_PHONE_PFX = "Phone_PFX"
ELEMENT_SLS_SIZE = "Sls_Size"
ELEMENT_EMP_SIZE = "Emp_Size"

# Dashboard element distribution: element code -> display label, in display order.
ELEMENT_LABELS = [
    ("Name", "Name"),
    ("Emp_Size", "Emp Size"),
    ("Sls_Size", "Sales Size"),
    ("AIN", "AIN"),
    ("Phone_AREA", "Phone Area"),
    ("Phone_PFX", "Phone PFX"),
    ("Phone_SFX", "Phone SFX"),
    ("SIC", "SIC"),
]

# Sentinel dates in the supplement, replaced in two passes (before and after dedupe).
SENTINEL_ISO = {"0401-01-01": "1970-01-01"}
SENTINEL_US = {"01/01/0401": "01-01-1800"}

# USPS record types.
STANDARD_TYPES = ["F", "G", "H", "P", "R", "S"]
VERIFIED_TYPES = ["F", "H", "S"]
MULTI_UNIT_TYPE = "H"
SINGLE_LOC_TYPE = "S"
ZIP_OK_STATUS = ["A", "C"]

# Columns trimmed between the base and the derived level.
TRIMMED_AFTER_BASE = ["verified_addr", "hyg_cmra_in", "hyg_residential_in", "std_addr",
                      "miss_ste_addr", "innac_ste_addr", "no_dir_strtnm_ste_zip"]

# Government-location rule.
GOVT_NAICS_PREFIX = "92"
GOVT_EXCLUDED_SUPPLIER = 508673
GOVT_YEARS = ["2017", "2018", "2019", "2020"]
GOVT_ACTIVITY = ["A", "B", "C"]

# Target layouts (column order of the written tables).
CHANGES_LAYOUT = ["trn_ts", "pbin", "column_nm", "table_nm", "after", "before",
                  "sbu_user_id", "sbu_supplier_nb"]
SUPPLEMENT_LAYOUT = ["pbin", "bin", "lvid", "value", "element", "ty_cd", "supplier_nb",
                     "dt_first_rpted", "dt_last_rpted", "supplier_nm"]
ENTITY_LOCATION_COLUMNS = ["pbin", "child_pbin", "lvid", "std_usps_nprf_str", "std_city_nm",
                           "std_state_cd", "std_zip5_cd", "ain", "name_norm_long",
                           "ol_lgl_nm_long"]

ADDRESS_INPUT_COLUMNS = [
    "ain", "std_addr_hsh_nb", "std_hse_nb", "std_str_addr", "std_str_sfx", "std_pre_direction",
    "std_pst_direction", "std_zip4_cd", "std_zip5_cd", "std_unit_ty_cd", "std_unit_nb",
    "std_unit_rc", "std_po_box_nb", "std_carr_rout", "std_state_cd", "std_city_nm",
    "std_sh_city_nm", "std_carr_rout_rc", "std_city_state_rc", "std_fips_state_cd",
    "std_fips_cnty_cd", "std_usps_cnty_nm", "std_msa_cd", "std_long_lat_level", "std_latitude",
    "std_latitude_dir", "std_longitude", "std_longitude_dir", "std_rtn_cd", "std_usps_rc_ty_cd",
    "std_zip5_rc", "std_zip4_rc", "std_sa_rc", "std_g9_rc", "std_zip_cd_stat_cd",
    "std_census_tract", "std_rur_hw_cntr_ty", "std_rur_hw_cntr_nb", "std_prv_mailbox_nb",
    "std_firm_rc", "std_ovall_prbl_cor", "std_str_nm_sc", "std_addr_prbl_cor",
    "std_delv_seq_fnote", "std_delv_pt_bar_cd", "std_delv_pt_bar_ad", "std_delv_cd",
    "std_upd_dt", "std_db_ver_nb", "std_usps_nprf_city", "std_usps_nprf_str", "std_usps_nprf_rc",
    "std_usps_nprf_rcty", "hyg_dsf2_bus_in", "hyg_dsf_cd", "hyg_dsf_dwg_cd", "hyg_dsf_delv_ty",
    "hyg_dsf_aqi_cd", "hyg_dsf_seas_cd", "hyg_dsf_vacant_in", "hyg_residential_in",
    "hyg_dwg_cd", "hyg_dsf_fnote", "hyg_zap_in", "hyg_proc_dt", "hyg_dsf_drop_in",
    "hyg_dsf2_vrf_cd", "hyg_dsf2_rec_ty_cd", "hyg_software_cd", "hyg_cmra_in",
    "hyg_delv_pt_bar_cd", "hyg_lacs_in", "hyg_lacs_dt", "create_db_dt", "upd_db_dt", "upd_db_id",
]
ADDRESS_DERIVED_COLUMNS = [
    "std_addr", "verified_addr", "rsdl", "comml", "non_phys", "comp_addr", "miss_ste_addr",
    "innac_ste_addr", "ste_for_single_loc_addr", "cmra", "multiunit_addr", "single_loc_addr",
    "no_dir_strtnm_zip", "no_dir_strtnm_ste_zip", "govt",
]
ADDRESS_LAYOUT = ADDRESS_INPUT_COLUMNS + ADDRESS_DERIVED_COLUMNS

# Survey definition: (question, options, input_type, input_id); every question
# is required and has no dependence.
SURVEY_QUESTIONS = [
    ("What's your name?", ["Your Name"], "text", "name"),
    ("What is your favorite food?", ["Type"], "text", "food"),
    ("What is your favorite hobbie?", ["Type"], "text", "hobbie"),
    ("Your Age", ["Type"], "numeric", "age"),
    ("Province", ["San Jose", "Alajuela", "Heredia", "Cartago", "Guanacaste", "Puntarenas",
                  "Limon"], "select", "province"),
    ("Gender", ["M", "F", "Other"], "mc", "gender"),
]

# ---------------------------------------------------------------------------
# Schemas of the logical tables (types are our choice where none is declared)
# ---------------------------------------------------------------------------

S = T.StringType()

RAW_CHANGES_SCHEMA = T.StructType([
    T.StructField("pbin", S), T.StructField("trn_ts", S), T.StructField("table_nm", S),
    T.StructField("column_nm", S), T.StructField("after_value", S),
    T.StructField("before_value", S), T.StructField("sbu_user_id", S),
    T.StructField("sbu_supplier_nb", T.IntegerType()),
])

CHANGES_SCHEMA = T.StructType([
    T.StructField("trn_ts", S), T.StructField("pbin", S), T.StructField("column_nm", S),
    T.StructField("table_nm", S), T.StructField("after", S), T.StructField("before", S),
    T.StructField("sbu_user_id", S), T.StructField("sbu_supplier_nb", T.IntegerType()),
])

SUPPLEMENT_SCHEMA = T.StructType([
    T.StructField("pbin", S), T.StructField("bin", S), T.StructField("lvid", S),
    T.StructField("value", S), T.StructField("element", S), T.StructField("ty_cd", S),
    T.StructField("supplier_nb", T.IntegerType()), T.StructField("dt_first_rpted", S),
    T.StructField("dt_last_rpted", S), T.StructField("supplier_nm", S),
])

ENTITY_LOCATIONS_SCHEMA = T.StructType([T.StructField(c, S) for c in ENTITY_LOCATION_COLUMNS])

SUPPLIERS_SCHEMA = T.StructType([
    T.StructField("supplier_nb", T.IntegerType()), T.StructField("supplier_nm", S),
])

ADDRESS_SCHEMA = T.StructType([T.StructField(c, S) for c in ADDRESS_INPUT_COLUMNS])

CONTROL_SCHEMA = T.StructType([
    T.StructField("table", S), T.StructField("source", S), T.StructField("destination", S),
    T.StructField("last_update", S), T.StructField("update_freq", T.IntegerType()),
])
