"""USPS address classification rules.

Flags are strings: '1', '0', or NULL where a rule does not apply. Base flags
read raw columns; derived flags read base flags (after a trim); ``govt`` reads
the joined government marker. The rules are SQL CASE expressions: each level
is one projection, built with a single ``selectExpr``/``expr`` call.
"""

from __future__ import annotations

from entwise import schemas as S

KEY_PARTS_WITH_UNIT = ["std_hse_nb", "std_pre_direction", "std_str_addr", "std_pst_direction",
                       "std_unit_nb", "std_zip5_cd"]
KEY_PARTS_NO_UNIT = ["std_hse_nb", "std_pre_direction", "std_str_addr", "std_pst_direction",
                     "std_zip5_cd"]


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _flag(cond: str) -> str:
    """'1' when cond is TRUE, otherwise (FALSE or NULL) '0'."""
    return f"CASE WHEN {cond} THEN '1' ELSE '0' END"


def address_key_sql(with_unit: bool = True) -> str:
    """Pipe-separated address key; NULL parts become '' so separators never shift."""
    parts = KEY_PARTS_WITH_UNIT if with_unit else KEY_PARTS_NO_UNIT
    return "concat_ws('|', " + ", ".join(f"coalesce({p}, '')" for p in parts) + ")"


def base_flag_sql() -> dict[str, str]:
    rc = "std_usps_rc_ty_cd"
    zip_ok = f"std_zip_cd_stat_cd IN {_in(S.ZIP_OK_STATUS)} AND std_rtn_cd IS NULL"
    multi, single = f"{rc} = '{S.MULTI_UNIT_TYPE}'", f"{rc} = '{S.SINGLE_LOC_TYPE}'"
    return {
        "std_addr": _flag(f"{zip_ok} AND {rc} IN {_in(S.STANDARD_TYPES)}"),
        "verified_addr": _flag(f"{zip_ok} AND {rc} IN {_in(S.VERIFIED_TYPES)}"),
        "miss_ste_addr": f"CASE WHEN {multi} AND std_unit_nb IS NULL THEN '1' "
                         f"WHEN {multi} AND std_unit_nb IS NOT NULL THEN '0' END",
        "innac_ste_addr": f"CASE WHEN {multi} AND std_unit_nb IS NOT NULL AND std_ovall_prbl_cor != '0' "
                          f"THEN '1' WHEN {multi} AND std_ovall_prbl_cor = '0' THEN '0' END",
        "ste_for_single_loc_addr":
            f"CASE WHEN {single} AND std_unit_nb IS NOT NULL AND std_ovall_prbl_cor != '0' THEN '1' "
            f"WHEN {single} AND std_unit_nb IS NULL AND std_ovall_prbl_cor = '0' THEN '0' END",
        "cmra": _flag("hyg_cmra_in = 'Y'"),
        "multiunit_addr": _flag(multi),
        "single_loc_addr": _flag(single),
        "no_dir_strtnm_zip": address_key_sql(with_unit=False),
        "no_dir_strtnm_ste_zip": address_key_sql(with_unit=True),
    }


def derived_flag_sql() -> dict[str, str]:
    verified = "verified_addr = '1'"
    suite = ["miss_ste_addr", "innac_ste_addr", "ste_for_single_loc_addr"]
    complete = " AND ".join([verified] + [f"({c} = '0' OR {c} IS NULL)" for c in suite])
    problem = " OR ".join(f"{c} = '1'" for c in suite)
    return {
        "rsdl": _flag(f"{verified} AND (hyg_cmra_in = 'N' OR hyg_cmra_in IS NULL) "
                      "AND hyg_residential_in = 'Y'"),
        "comml": _flag(f"{verified} AND (hyg_residential_in = 'N' OR hyg_residential_in IS NULL)"),
        "non_phys": _flag("std_addr = '1' AND verified_addr = '0'"),
        "comp_addr": f"CASE WHEN {complete} THEN '1' WHEN {verified} AND ({problem}) THEN '0' END",
    }


GOVT_SQL = _flag("verified_addr = '1' AND govt_flag = '1' AND comml = '1'")
