"""Wide <-> long reshaping and stacking of frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.operators.selection import quoted


def melt(df: DataFrame, ids, values=None, variable: str = "series",
         value: str = "value", value_type: str = "string") -> DataFrame:
    """Wide -> long: one row per (id columns, value column).  NULL cells are
    kept.  Value columns are brought to one type first (``value_type``)
    because Spark's unpivot needs a single value type."""
    ids = list(ids)
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    typed = df.select(*[quoted(c) for c in ids],
                      *[quoted(c).cast(value_type).alias(c) for c in values])
    return typed.unpivot([quoted(c) for c in ids], [quoted(c) for c in values], variable, value)


def tagged_union(frames: dict, tag: str = "dwelling_type") -> DataFrame:
    """Stack frames by column name, each tagged with its key (missing columns
    become NULL)."""
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
