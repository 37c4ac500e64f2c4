"""Supplier-reported attribute supplements (SIC, phone parts, size measures).

One operator covers every element: a spec says which source column is the
value, which is the type code, and how the value is cleaned. Several specs on
one source are unpivoted in a single scan, and all sources are unioned before
the one join to the changed entities' locations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.operators.incremental import not_yet_loaded
from entwise.operators.runtime_filter import KeyFilter
from entwise.operators.skew import spread_join

SOURCE_KEYS = ["lvid", "supplier_nb", "dt_first_rpted", "dt_last_rpted"]
# Anti-join keys against the loaded supplement. ``element`` is part of the key
# so an area code cannot suppress an equal prefix for the same location.
LOAD_KEYS = ["lvid", "supplier_nb", "dt_last_rpted", "value", "element"]


@dataclass(frozen=True)
class ElementSpec:
    element: str
    value_col: str
    ty_cd_col: str | None = None     # None -> typed NULL type code
    clean: str | None = None         # "leading_digits" for size values like '1200.50'

    def value_sql(self) -> str:
        v = f"`{self.value_col}`"
        return f"regexp_extract({v}, '^[0-9]*', 0)" if self.clean == "leading_digits" else v

    def ty_cd_sql(self) -> str:
        return f"`{self.ty_cd_col}`" if self.ty_cd_col else "CAST(NULL AS STRING)"


SIC = ElementSpec(S.ELEMENT_SIC, "sic_cd", "sic_ty_cd")
PHONE_AREA = ElementSpec(S.ELEMENT_PHONE_AREA, "ph_area_cd")
PHONE_PFX = ElementSpec(S.ELEMENT_PHONE_PFX, "ph_nb_pfx")
SLS_SIZE = ElementSpec(S.ELEMENT_SLS_SIZE, "act_sls_sz", "sls_sz_cd", clean="leading_digits")
EMP_SIZE = ElementSpec(S.ELEMENT_EMP_SIZE, "act_emp_sz", "emp_sls_sz_ty_cd")


def unpivot_elements(source: DataFrame, specs: Sequence[ElementSpec]) -> DataFrame:
    """One pass over ``source``: each row becomes one row per spec with
    (lvid, supplier_nb, dt_first_rpted, dt_last_rpted, element, value, ty_cd)."""
    if len(specs) == 1:
        s = specs[0]
        return source.selectExpr(*SOURCE_KEYS, f"'{s.element}' AS element",
                                 f"CAST({s.value_sql()} AS STRING) AS value",
                                 f"{s.ty_cd_sql()} AS ty_cd")
    rows = ", ".join(f"'{s.element}', CAST({s.value_sql()} AS STRING), {s.ty_cd_sql()}" for s in specs)
    return source.selectExpr(*SOURCE_KEYS, f"stack({len(specs)}, {rows}) AS (element, value, ty_cd)")


def entity_locations_of(changes: DataFrame, entity_locations: DataFrame) -> DataFrame:
    """(pbin, bin, lvid) of the entities that have changes.

    A semi-join: keeps each location row once, whatever the number of change
    rows per entity; entities without a location drop out (they would not
    survive the join on ``lvid`` anyway). The change log has many rows per
    entity, so it is reduced to its entities first; that makes it an aggregate,
    so an entity with very many locations is spread by a fixed factor.
    """
    changed = changes.select("pbin").distinct()
    locs = entity_locations.select("pbin", F.col("child_pbin").alias("bin"), "lvid")
    return spread_join(locs, changed, ["pbin"], "left_semi")


def build(changes: DataFrame, entity_locations: DataFrame, suppliers: DataFrame,
          sources: Sequence[tuple[DataFrame, Sequence[ElementSpec]]],
          loaded: DataFrame | None = None, prefilter: bool = True, filter_bits: int | None = None) -> DataFrame:
    """Supplement rows in ``SUPPLEMENT_LAYOUT`` for every (source, specs) pair.

    Steps: drop source rows of other locations at the scan -> unpivot each source
    (cleaning values first, so the incremental key is the stored value) -> union
    -> join to the changed entities' locations on ``lvid`` -> skip rows already in
    ``loaded`` -> attach supplier names.

    Sources and ``loaded`` are far larger than the changed locations, so both are
    reduced before they are shuffled, by a filter from the locations' keys
    (``runtime_filter``, of ``filter_bits`` bits; without ``prefilter`` it is left
    out, with the same rows). The location join comes before the anti-join because it is the
    selective step; AQE may split a hot ``lvid`` because both join inputs are
    shuffles.
    """
    locations = entity_locations_of(changes, entity_locations)
    asked = KeyFilter(locations, "lvid", filter_bits).holds("lvid") if prefilter else F.lit(True)
    long = None
    for df, specs in sources:
        part = unpivot_elements(df.filter(asked), specs)
        long = part if long is None else long.unionByName(part)
    located = locations.join(long, "lvid", "inner")
    if loaded is not None:
        # only the elements being built can match; with a target partitioned
        # by element this prunes partitions, and it shrinks the anti-join shuffle
        elements = sorted({s.element for _, specs in sources for s in specs})
        located = not_yet_loaded(located, loaded.filter(F.col("element").isin(*elements) & asked), LOAD_KEYS)
    named = located.join(suppliers.select("supplier_nb", "supplier_nm"), "supplier_nb", "left")
    return named.select(*S.SUPPLEMENT_LAYOUT)
