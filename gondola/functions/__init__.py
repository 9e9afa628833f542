"""Column-level functions (pure ``pyspark.sql.functions`` compositions)."""

from gondola.functions.agg import (  # noqa: F401
    any_null,
    distinct_non_null_count,
    n_unique,
    null_count,
    safe_div,
    sum_or_zero,
)
from gondola.functions.text import (  # noqa: F401
    amount_text,
    cast_amount,
    classification_path,
    clean_department,
    department_from_zip,
    extract_quantities,
    fill_empty,
    format_quantities,
    null_if,
    parse_amount,
    remove_first_space,
    replace_first,
    replace_first_literal,
    strip_chars,
    strip_department_prefix,
    widen_year,
    zero_fill,
)
