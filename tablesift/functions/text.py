"""Column-expression helpers for text.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_name(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """``F.col`` for a raw header name (``x.y`` is one column, not a field)."""
    return F.col(quote_name(name))


def file_stem(c: Column) -> Column:
    """File name up to the first dot (``lineitem.tbl.csv`` -> ``lineitem``)."""
    return F.substring_index(c, ".", 1)


def bracket_list(arr: Column) -> Column:
    """Render an array of strings as ``[a, b]`` (Java ``Arrays.toString``)."""
    return F.concat(F.lit("["), F.array_join(arr, ", "), F.lit("]"))
