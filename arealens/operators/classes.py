"""Very many overlapping selections at once, by classes of blocks.

Blocks that lie in exactly the same selections form a class.  Facts meet one
row per class, never one per selection; the selections are put together from
the classes' sums afterwards.  Work over the facts grows with the number of
classes, however many selections contain a block.

A class is known by the number of its selections and two sums of 64-bit hashes
of their names: partial aggregates, so the selections of a block are never
gathered into one list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.operators.selection import bounded_broadcast, dealt, staged


def refine(members: DataFrame, element, group: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Partition refinement of ``members`` (``element`` columns, ``group``): elements in
    exactly the same groups share a class.

    Returns ((element, name), one row per element, and (name, group), one row per
    class and group it lies in); ``name`` is a digest that stands for the class."""
    keys = [element] if isinstance(element, str) else list(element)
    pairs = dealt(members.select(*keys, group), *keys, group).distinct()
    h1, h2 = F.xxhash64(group).cast("decimal(20,0)"), F.xxhash64(F.lit("2"), F.col(group)).cast("decimal(20,0)")
    signed = staged(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(h1).alias("_a"), F.sum(h2).alias("_b")))
    first = signed.groupBy("_n", "_a", "_b").agg(F.min(F.struct(*keys)).alias("_first"))
    first = staged(first.withColumn(name, F.unhex(F.md5(F.concat_ws(",", "_n", "_a", "_b")))))
    known = bounded_broadcast(first.drop("_first"))
    elements = signed.join(known, ["_n", "_a", "_b"]).select(*keys, name)
    heads = bounded_broadcast(first.select(*[F.col(f"_first.{k}").alias(k) for k in keys], name))
    groups = members.select(*keys, group).join(heads, keys).select(name, group).distinct()  # one element per class
    return staged(elements), staged(groups)


def overlapping_distribution(measure: DataFrame, concord: DataFrame, selections: DataFrame, years=None) -> DataFrame:
    """``apportioned_distribution`` for very many overlapping selections:
    (selection_id, eq_income_weekly, eq_income_yearly, value, year), unordered.

    ``selections``: (selection_id, block_id).  Shares are summed per (class,
    area, year) and meet the measure once; the sums per class and bucket are
    then added up per selection.  Exact for decimal measures and shares."""
    blocks, members = refine(selections.select("selection_id", F.col("block_id").cast("string").alias("block_id")),
                             "block_id", "selection_id", "class_id")
    cc, m = concord, measure
    if years is not None:
        cc, m = cc.filter(F.col("year").isin(list(years))), m.filter(F.col("year").isin(list(years)))
    # one shuffle, on the keys of the join, serves the shares and the join
    shares = (dealt(cc.join(bounded_broadcast(blocks), "block_id"), "sa1_7dig", "year", rows=cc.count())
                .groupBy("class_id", "sa1_7dig", "year").agg(F.sum("per_pct").alias("share")))
    parts = (m.select("sa1_7dig", "year", "eq_income_yearly", "eq_income_weekly", "value")
              .join(shares, ["sa1_7dig", "year"])
              .groupBy("class_id", "eq_income_yearly", "eq_income_weekly", "year")
              .agg(F.sum(F.col("value") * F.col("share")).alias("part")))
    return (parts.join(members, "class_id")
                 .groupBy("selection_id", "eq_income_yearly", "eq_income_weekly", "year")
                 .agg(F.round(F.sum("part")).cast("double").alias("value"))
                 .select("selection_id", "eq_income_weekly", "eq_income_yearly", "value", "year"))


def overlapping_index(index: DataFrame, concord: DataFrame, selections: DataFrame, years=None) -> DataFrame:
    """``weighted_index`` for very many overlapping selections:
    (selection_id, seifaindextype, seifa_measure, value, year).

    Areas that the same classes reach form a class of their own (a second
    refinement), so an area counts once per selection although several classes
    reach it; persons and weights are summed once per class of areas."""
    blocks, members = refine(selections.select("selection_id", F.col("block_id").cast("string").alias("block_id")),
                             "block_id", "selection_id", "class_id")
    cc = concord if years is None else concord.filter(F.col("year").isin(list(years)))
    area = ["sa1_main", "sa1_persons", "year"]
    reached = staged(cc.join(bounded_broadcast(blocks), "block_id").select(*area, "class_id").distinct())
    areas, reaching = refine(reached, area, "class_id", "area_class")
    idx = index.filter(F.col("value").isNotNull()).select("sa1_main", "seifaindextype", "seifa_measure", "value").distinct()
    sums = (idx.join(areas, "sa1_main").groupBy("area_class", "seifaindextype", "seifa_measure", "year")
               .agg(F.sum(F.col("value") * F.col("sa1_persons")).alias("weight"), F.sum("sa1_persons").alias("persons")))
    within = reaching.join(members, "class_id").select("selection_id", "area_class").distinct()
    return (sums.join(within, "area_class").groupBy("selection_id", "seifaindextype", "seifa_measure", "year")
                .agg(F.round(F.try_divide(F.sum("weight"), F.sum("persons"))).cast("double").alias("value"))
                .select("selection_id", "seifaindextype", "seifa_measure", "value", "year"))
