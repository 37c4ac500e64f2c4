"""Column-level rules. Every function returns a ``pyspark.sql.Column`` built from
built-in expressions, so they stay inside whole-stage codegen (no Python UDFs)."""

from entwise.functions.text import (  # noqa: F401
    blank_to_empty, code_map, leading_digits, lenient_gt, replace_values, strip_leading_zeros,
    strip_zeros_if_gt_one, day_of,
)
from entwise.functions.address import (  # noqa: F401
    address_key_sql, base_flag_sql, derived_flag_sql,
)
