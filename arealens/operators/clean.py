"""Frame-level cleaning: markers, casts, names and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.text import lenient_number, strip_marker
from arealens.operators.selection import quoted


def strip_markers_all(df: DataFrame, marker: str = "<", columns=None) -> DataFrame:
    """Remove ``marker`` from every string column (or from ``columns``), in
    one projection."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: strip_marker(quoted(c), marker) for c in cols})


def cast_numbers(df: DataFrame, columns) -> DataFrame:
    """Lenient text -> double for the named columns (bad text -> NULL)."""
    return df.withColumns({c: lenient_number(quoted(c)) for c in columns})


def fill_numeric_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """NULL -> ``value`` in numeric columns only."""
    return df.fillna(value)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name (values untouched)."""
    return df.toDF(*[c.lower() for c in df.columns])


def keep_present(df: DataFrame, *columns) -> DataFrame:
    """Drop rows whose key cells are NULL (footnotes, blank rows)."""
    cond = None
    for c in columns:
        cond = quoted(c).isNotNull() if cond is None else cond & quoted(c).isNotNull()
    return df.filter(cond)


def drop_labels(df: DataFrame, column: str, labels) -> DataFrame:
    """Remove subtotal / header remnant rows; NULL keys are removed too, as
    ``col != label`` is not true for NULL."""
    cond = None
    for lab in ([labels] if isinstance(labels, str) else labels):
        cond = (quoted(column) != lab) if cond is None else cond & (quoted(column) != lab)
    return df.filter(cond)


def keep_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Area codes starting with ``prefix``; the column is compared as text."""
    return df.filter(quoted(column).cast("string").startswith(prefix))


def keep_positive(df: DataFrame, column: str = "value", compare: str = "numeric") -> DataFrame:
    """Rows with a positive value.  ``compare="numeric"`` reads the cell as a
    number (text and NULL drop out); ``compare="text"`` compares the text with
    "0" as an all-text sheet would ("n.p." passes, NULL drops)."""
    if compare == "text":
        return df.filter(quoted(column).cast("string") > F.lit("0"))
    return df.filter(lenient_number(quoted(column).cast("string")) > 0)
