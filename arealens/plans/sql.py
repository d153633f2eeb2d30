"""The area queries as SQL table functions.

``register_area_functions(spark)`` creates temporary functions, so that a SQL
user writes

    SELECT * FROM income_distribution(array('73', '74'), array(2016))
    SELECT * FROM seifa_index(array('73'), array('IRSD'), array('SCORE'), array(2016))
    SELECT * FROM area_series_payment_types_qrt_sa2(array('73'))

Table names are bound with IDENTIFIER(:name) when the functions are created;
no SQL text is put together.  A block list limits the concordance twice: by
its least and greatest id, which are constants and reach the Parquet scan, and
by membership.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from arealens.operators.selection import SEIFA_INDEX_TYPES, SEIFA_MEASURES, SUPPORTED_YEARS
from arealens.plans import catalog as C



def _checked(argument: str, name: str, values) -> str:
    """SQL of an array argument whose members must be among ``values``."""
    known = ", ".join(repr(v) for v in values)
    return (f"CASE WHEN size(array_except({argument}, array({known}))) > 0 "
            f"THEN raise_error('{name} should be one of {', '.join(map(str, values))}') ELSE {argument} END")


_YEARS = f"array_contains({_checked('years', 'year', SUPPORTED_YEARS)}, year)"
_BLOCKS = "block_id BETWEEN array_min(blocks) AND array_max(blocks) AND array_contains(blocks, block_id)"

INCOME = f"""
CREATE OR REPLACE TEMPORARY FUNCTION income_distribution(blocks ARRAY<STRING>, years ARRAY<INT>)
RETURNS TABLE(eq_income_weekly STRING, eq_income_yearly STRING, value DOUBLE, year INT)
RETURN
  SELECT eq_income_weekly, eq_income_yearly, CAST(round(sum(value * share)) AS DOUBLE), year
  FROM IDENTIFIER(:measure) JOIN (
    SELECT sa1_7dig, year, sum(per_pct) AS share FROM IDENTIFIER(:concord)
    WHERE {_BLOCKS} AND {_YEARS}
    GROUP BY sa1_7dig, year) USING (sa1_7dig, year)
  GROUP BY eq_income_weekly, eq_income_yearly, year"""

SEIFA = f"""
CREATE OR REPLACE TEMPORARY FUNCTION seifa_index(blocks ARRAY<STRING>, index_types ARRAY<STRING>,
                                                 measures ARRAY<STRING>, years ARRAY<INT>)
RETURNS TABLE(seifaindextype STRING, seifa_measure STRING, value DOUBLE, year INT)
RETURN
  SELECT seifaindextype, seifa_measure, CAST(round(try_divide(sum(weight), sum(sa1_persons))) AS DOUBLE), year
  FROM (
    SELECT DISTINCT sa1_main, sa1_persons, seifaindextype, seifa_measure, i.value, c.year, i.value * sa1_persons AS weight
    FROM (SELECT sa1_main, seifaindextype, seifa_measure, value FROM IDENTIFIER(:index)
          WHERE value IS NOT NULL
            AND array_contains({_checked("index_types", "seifaindex", SEIFA_INDEX_TYPES)}, seifaindextype)
            AND array_contains({_checked("measures", "measure", SEIFA_MEASURES)}, seifa_measure)) i
    JOIN (SELECT DISTINCT sa1_main, sa1_persons, year FROM IDENTIFIER(:concord)
          WHERE {_BLOCKS} AND {_YEARS}) c USING (sa1_main))
  GROUP BY seifaindextype, seifa_measure, year"""

_DATE = "try_to_date(replace({0}, '-', ' '), 'MMMM yyyy')"
_SA2 = f"SELECT DISTINCT sa2_5dig, sa2_main, sa2_name FROM IDENTIFIER(:concord) WHERE {_BLOCKS}"
_POSTCODE = f"SELECT DISTINCT abs_postcode AS postcode FROM IDENTIFIER(:concord) WHERE {_BLOCKS}"

SERIES = {
    "jobseeker_monthly_payments_sa2": f"""
CREATE OR REPLACE TEMPORARY FUNCTION area_series_jobseeker_monthly_payments_sa2(blocks ARRAY<STRING>)
RETURNS TABLE(sa2_main STRING, sa2_name STRING, month DATE, series STRING, value DOUBLE)
RETURN SELECT sa2_main, sa2_name, month, series, value FROM (
  SELECT DISTINCT sa2_5dig, c.sa2_main, c.sa2_name, {_DATE.format("month")} AS month, series, value
  FROM IDENTIFIER(:fact) f JOIN ({_SA2}) c USING (sa2_5dig))""",
    "jobkeeper_monthly_applications_pc": f"""
CREATE OR REPLACE TEMPORARY FUNCTION area_series_jobkeeper_monthly_applications_pc(blocks ARRAY<STRING>)
RETURNS TABLE(postcode STRING, month DATE, value BIGINT)
RETURN SELECT DISTINCT postcode, {_DATE.format("month")}, applications
  FROM IDENTIFIER(:fact) f JOIN ({_POSTCODE}) c USING (postcode)""",
    "payment_types_qrt_pc": f"""
CREATE OR REPLACE TEMPORARY FUNCTION area_series_payment_types_qrt_pc(blocks ARRAY<STRING>)
RETURNS TABLE(postcode STRING, quarter DATE, series STRING, value DOUBLE)
RETURN SELECT DISTINCT postcode, {_DATE.format("quarter")}, series, value
  FROM IDENTIFIER(:fact) f JOIN ({_POSTCODE}) c USING (postcode)""",
    "payment_types_qrt_sa2": f"""
CREATE OR REPLACE TEMPORARY FUNCTION area_series_payment_types_qrt_sa2(blocks ARRAY<STRING>)
RETURNS TABLE(sa2_main STRING, sa2_name STRING, quarter DATE, series STRING, value DOUBLE)
RETURN SELECT sa2_main, sa2_name, quarter, series, value FROM (
  SELECT DISTINCT sa2_5dig, c.sa2_main, c.sa2_name, {_DATE.format("quarter")} AS quarter, series, value
  FROM IDENTIFIER(:fact) f JOIN ({_SA2}) c USING (sa2_5dig))""",
    "sa2_salm": f"""
CREATE OR REPLACE TEMPORARY FUNCTION area_series_sa2_salm(blocks ARRAY<STRING>)
RETURNS TABLE(sa2_main STRING, sa2_name STRING, quarter DATE, series STRING, value DOUBLE)
RETURN SELECT DISTINCT sa2_main, c.sa2_name, {_DATE.format("quarter")}, series, value
  FROM IDENTIFIER(:fact) f JOIN (SELECT DISTINCT sa2_main, sa2_name FROM IDENTIFIER(:concord) WHERE {_BLOCKS}) c
  USING (sa2_main)""",
}


def register_area_functions(spark: SparkSession, names: dict[str, str] | None = None, series=tuple(SERIES)) -> None:
    """Create the functions over the catalog's tables.  ``names`` maps the default
    table names to others (views of the session, say); ``series`` limits the
    area series to tables that exist, since a function is checked when created."""
    def name(default: str) -> str:
        return (names or {}).get(default, default)

    spark.sql(INCOME, args={"measure": name(f"abs.{C.INCOME_TABLE}"), "concord": name(C.CONCORD_SA1)})
    spark.sql(SEIFA, args={"index": name(f"abs.{C.SEIFA_TABLE}"), "concord": name(C.CONCORD_SA1)})
    for table in series:
        concord = C.CONCORD_POSTCODE if table.endswith("_pc") else C.CONCORD_SA2
        spark.sql(SERIES[table], args={"fact": name(f"{C.SERIES_SCHEMAS[table]}.{table}"), "concord": name(concord)})
