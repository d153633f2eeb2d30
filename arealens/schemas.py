"""Explicit schemas of the public tables and of the sheet landing table.

The reference ships no DDL; numeric types marked "assumed" follow how the
columns are used (shares and counts multiplied, persons summed).
"""

from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, I, L, DT = StringType(), DoubleType(), IntegerType(), LongType(), DateType()

# Concordances (block <-> statistical area).
CBSA1MB = _s(("block_id", S), ("sa1_7dig", S), ("sa1_main", S),
             ("sa1_persons", L), ("per_pct", D), ("year", I))        # assumed numeric types
CBSA2 = _s(("block_id", S), ("sa2_5dig", S), ("sa2_main", S), ("sa2_name", S))
CBPOSTCODES = _s(("block_id", S), ("abs_postcode", S))

# Area facts.
SA1_INCOME = _s(("sa1_7dig", S), ("year", I), ("eq_income_yearly", S),
                ("eq_income_weekly", S), ("value", D))
SA1_SEIFA = _s(("sa1_main", S), ("seifaindextype", S), ("seifa_measure", S), ("value", D))
JOBSEEKER_SA2 = _s(("sa2_5dig", S), ("sa2_name", S), ("month", S), ("series", S),
                   ("value", D), ("month_date", DT))
JOBKEEPER_PC = _s(("postcode", S), ("month", S), ("applications", L))
PAYMENT_TYPES_PC = _s(("postcode", S), ("quarter", S), ("series", S), ("value", D),
                      ("month_date", DT))
PAYMENT_TYPES_SA2 = _s(("sa2_5dig", S), ("sa2_name", S), ("quarter", S), ("series", S),
                       ("value", D), ("month_date", DT))
PAYMENT_TYPES_LGA = _s(("lga_code", S), ("lga_name", S), ("quarter", S), ("series", S),
                       ("value", D), ("month_date", DT))
SA2_SALM = _s(("sa2_main", S), ("quarter", S), ("series", S), ("value", D))
LGA_RENTAL = _s(("lga", S), ("value", D), ("quarter", S), ("series", S),
                ("dwelling_type", S), ("month_date", DT))
SUBURB_RENTAL = _s(("suburb", S), ("value", D), ("quarter", S), ("series", S),
                   ("dwelling_type", S), ("month_date", DT))

# Landing table for published workbooks: one row per sheet row, cells as text,
# positions explicit because Spark rows carry no order.  Key: (source_url,
# sheet_no, row_no); each publication is landed once, as one file.
SHEET_ROWS = StructType([
    StructField("source_url", S, False),
    StructField("sheet_name", S, True),
    StructField("sheet_no", I, False),
    StructField("row_no", I, False),
    StructField("cells", ArrayType(S, True), True),
])

# Pages fetched by a crawler, input of the link inventory.
PAGES = _s(("page_id", L), ("url", S), ("html", S))
