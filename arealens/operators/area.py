"""Area queries: from a block selection through a concordance to area facts.

* ``apportioned_distribution`` - share-weighted sum of area counts.
* ``weighted_index`` - population-weighted mean of an area index.
* ``area_series`` - the time series of the areas the blocks fall in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.period import period_to_date
from arealens.functions.rank import INCOME_WEEKLY_RANKS, bucket_rank
from arealens.operators.selection import (SEIFA_INDEX_TYPES, SEIFA_MEASURES, SUPPORTED_YEARS,
                                          check_members, dealt, select_blocks)


# ---------------------------------------------------------------- T1 ------

def apportioned_distribution(measure: DataFrame, concord: DataFrame, blocks,
                             years=(2016,), supported_years=SUPPORTED_YEARS,
                             rank_rules=INCOME_WEEKLY_RANKS, ordered: bool = True,
                             with_rank: bool = False) -> DataFrame:
    """Counts of an area table apportioned to the selected blocks.

    measure: (sa1_7dig, year, eq_income_yearly, eq_income_weekly, value)
    concord: (block_id, sa1_7dig, year, per_pct) - per_pct is the share of the
             area that lies in the block; duplicate rows count every time.
    Result: [selection_id,] eq_income_weekly, eq_income_yearly,
    value = round(sum(value*per_pct)) (half up, as double), year
    [, bucket_rank], ordered by bucket rank (NULL last) then year.
    ``years=None`` keeps every year.

    Plan: the concordance is reduced to one row per (selection, area, year)
    with the summed share *before* the join (sum(v*p1)+sum(v*p2) =
    v*(p1+p2); exact for decimal inputs, equal up to float rounding for
    doubles), so a block set or area holding a large part of the concordance
    never reaches the join as many rows.  The final aggregate has
    a partial (map-side) stage, so hot buckets do not skew the shuffle.
    """
    cc, sel = select_blocks(concord, blocks)
    if years is not None:
        yrs = [int(y) for y in check_members("year", years, supported_years)]
        cc = cc.filter(F.col("year").isin(yrs))
        measure = measure.filter(F.col("year").isin(yrs))
    if sel:  # whole concordances: one shuffle, on the keys of the join, serves the shares and the join
        cc = dealt(cc, "sa1_7dig", "year", rows=concord.count())
    shares = (cc.groupBy(*sel, "sa1_7dig", "year")
                .agg(F.sum("per_pct").alias("share")))
    m = measure.select("sa1_7dig", "year", "eq_income_yearly", "eq_income_weekly", "value")
    joined = m.join(shares, ["sa1_7dig", "year"], "inner")
    out = (joined.groupBy(*sel, "eq_income_yearly", "eq_income_weekly", "year")
                 .agg(F.round(F.sum(F.col("value") * F.col("share"))).cast("double").alias("value")))
    out = out.select(*sel, "eq_income_weekly", "eq_income_yearly", "value", "year")
    rank = bucket_rank("eq_income_weekly", rank_rules)
    if with_rank:
        out = out.withColumn("bucket_rank", rank)
    if ordered:
        out = out.orderBy(*[F.col(s) for s in sel], rank.asc_nulls_last(), F.col("year"))
    return out


# ---------------------------------------------------------------- T2 ------

def weighted_index(index: DataFrame, concord: DataFrame, blocks,
                   index_types=("IRSD",), measures=("SCORE",), years=(2016,),
                   supported_index_types=SEIFA_INDEX_TYPES, supported_measures=SEIFA_MEASURES,
                   supported_years=SUPPORTED_YEARS, join_year: bool = False) -> DataFrame:
    """Population-weighted mean of an area index over the selected blocks.

    index:   (sa1_main, seifaindextype, seifa_measure, value [, year])
    concord: (block_id, sa1_main, sa1_persons, year)
    Result: [selection_id,] seifaindextype, seifa_measure, value, year with
    value = round(sum(value*persons)/sum(persons)) (half up, as double); NULL
    when the population is zero.  ``None`` for a filter keeps every value.

    Each area counts once however many selected blocks fall in it (distinct
    concordance rows), and equal index values of different areas are both
    kept (the distinct key includes the area).  The index is joined on the
    area only, as published indexes are per census; ``join_year=True`` adds the
    year to the key for an index frame that holds several years.
    """
    cc, sel = select_blocks(concord, blocks)
    if years is not None:
        yrs = [int(y) for y in check_members("year", years, supported_years)]
        cc = cc.filter(F.col("year").isin(yrs))
    key = ["sa1_main", "year"] if join_year else ["sa1_main"]
    cc = cc.select(*sel, "sa1_main", "sa1_persons", "year")
    if sel:  # whole concordances: one shuffle, on the keys of the join, serves both DISTINCTs and the join
        cc = dealt(cc, *key, rows=concord.count())
    cc = cc.distinct()
    idx = index.filter(F.col("value").isNotNull())
    if index_types is not None:
        idx = idx.filter(F.col("seifaindextype").isin(
            check_members("seifaindex", index_types, supported_index_types)))
    if measures is not None:
        idx = idx.filter(F.col("seifa_measure").isin(
            check_members("measure", measures, supported_measures)))
    idx = idx.select(*key, "seifaindextype", "seifa_measure", "value")
    rows = (idx.join(cc, key, "inner")
               .select(*sel, "sa1_main", "sa1_persons", "seifaindextype", "seifa_measure",
                       F.col("value").alias("seifa_index"), "year",
                       (F.col("value") * F.col("sa1_persons")).alias("weight"))
               .distinct())
    out = (rows.groupBy(*sel, "seifaindextype", "seifa_measure", "year")
               .agg(F.round(F.try_divide(F.sum("weight"), F.sum("sa1_persons")))
                     .cast("double").alias("value")))
    return out.select(*sel, "seifaindextype", "seifa_measure", "value", "year")


# ---------------------------------------------------------------- T3 ------

@dataclass(frozen=True)
class SeriesSpec:
    """How one area fact table is reached from the blocks.

    concord_key / fact_key: join columns; concord_cols: concordance columns kept;
    fact_cols: fact columns kept (in output order); period: text period column
    parsed to a date; keep_key: the fact key is part of the DISTINCT but not of
    the output; renames: output renames; order: sort columns.
    """
    concord: str
    concord_key: str
    fact_key: str
    concord_cols: tuple
    fact_cols: tuple
    period: str
    output: tuple
    order: tuple
    keep_key: bool = False
    renames: tuple = ()


# --- Fixed values: supported area tables, their concordance and layout. ----
AREA_SERIES_SPECS = {
    "jobseeker_monthly_payments_sa2": SeriesSpec(
        "cbsa2", "sa2_5dig", "sa2_5dig", ("sa2_main", "sa2_name"), ("month", "series", "value"),
        "month", ("sa2_main", "sa2_name", "month", "series", "value"),
        ("month", "series", "sa2_name"), keep_key=True),
    "jobkeeper_monthly_applications_pc": SeriesSpec(
        "cbpostcodes", "abs_postcode", "postcode", (), ("postcode", "month", "applications"),
        "month", ("postcode", "month", "value"), ("month", "postcode"),
        renames=(("applications", "value"),)),
    "payment_types_qrt_pc": SeriesSpec(
        "cbpostcodes", "abs_postcode", "postcode", (), ("postcode", "quarter", "series", "value"),
        "quarter", ("postcode", "quarter", "series", "value"), ("quarter", "series", "postcode")),
    "payment_types_qrt_sa2": SeriesSpec(
        "cbsa2", "sa2_5dig", "sa2_5dig", ("sa2_main", "sa2_name"), ("quarter", "series", "value"),
        "quarter", ("sa2_main", "sa2_name", "quarter", "series", "value"),
        ("quarter", "series", "sa2_main"), keep_key=True),
    "sa2_salm": SeriesSpec(
        "cbsa2", "sa2_main", "sa2_main", ("sa2_name",), ("sa2_main", "quarter", "series", "value"),
        "quarter", ("sa2_main", "sa2_name", "quarter", "series", "value"),
        ("quarter", "series", "sa2_main")),
}
# ---------------------------------------------------------------------------


def unknown_series(table: str) -> ValueError:
    return ValueError(f"no area series is laid out for table {table!r}; known: " + ", ".join(AREA_SERIES_SPECS))


def area_series(fact: DataFrame, concord: DataFrame, blocks,
                table: str = "jobseeker_monthly_payments_sa2",
                spec: SeriesSpec | None = None, ordered: bool = True,
                stored_date: bool = False) -> DataFrame:
    """Series of the areas the selected blocks fall in (no aggregation).

    ``table`` picks a layout from ``AREA_SERIES_SPECS``; ``spec`` overrides it.
    The period label is parsed to the first day of its month; with
    ``stored_date=True`` the fact's stored ``month_date`` is read instead (no
    per-row parsing; equal for rows written by this library's loads, which
    store the first of the month).  Rows are distinct, so an area reached
    through several blocks appears once.

    Plan: the selected concordance is made distinct on (selection, join key,
    kept columns) before the join - one row per area and label, however many
    blocks reach it - so the join does not multiply fact rows; it is small
    and AQE broadcasts it from its measured size.  The result DISTINCT has a
    map-side pass; with ``ordered`` its rows are then range-sorted on the sort
    keys and, behind them, all other columns, so a hot area or period is split.
    """
    if spec is None:
        if table not in AREA_SERIES_SPECS:
            raise unknown_series(table)
        spec = AREA_SERIES_SPECS[table]
    cc, sel = select_blocks(concord, blocks)
    cc = (cc.select(*sel, F.col(spec.concord_key).alias("_k"), *spec.concord_cols).distinct())
    if stored_date and "month_date" in fact.columns:
        fact = fact.withColumn(spec.period, F.col("month_date"))
    f = fact.select(F.col(spec.fact_key).alias("_k"),
                    *[c for c in spec.fact_cols if c != spec.fact_key])
    joined = f.join(cc, "_k", "inner")

    def fact_col(c):
        if c == spec.fact_key:
            return F.col("_k").alias(c)
        if c == spec.period and not (stored_date and "month_date" in fact.columns):
            return period_to_date(c).alias(c)
        return F.col(c)

    cols = [*sel] + ([F.col("_k")] if spec.keep_key else []) + \
        [F.col(c) for c in spec.concord_cols] + [fact_col(c) for c in spec.fact_cols]
    rows = joined.select(*cols)
    renamed = dict(spec.renames)
    if ordered:
        # the DISTINCT is reduced map-side before its shuffle; only its result is sorted
        inverse = {v: k for k, v in renamed.items()}
        first = [inverse.get(c, c) for c in [*sel, *spec.order]]
        rest = [c for c in rows.columns if c not in first]   # tie-breakers: whole rows
        rows = rows.distinct().orderBy(*[F.col(c).asc_nulls_last() for c in [*first, *rest]])
    else:
        rows = rows.distinct()
    for old, new in spec.renames:
        rows = rows.withColumnRenamed(old, new)
    return rows.select(*sel, *spec.output)
