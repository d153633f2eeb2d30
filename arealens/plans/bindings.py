"""The reference's tables, derived by Spark from the driver's test tables.

The area queries and loads need concordances, area facts and published
workbooks; the test data is a TPC-H-like star schema.  Each function here
maps those tables onto one reference shape with plain DataFrame
transformations, so every registered query reads whole tables and its work
grows with them.  Mapping (text ids throughout):

* blocks            = suppliers; a *selection* = all suppliers of one region
* cbsa1mb           = lineitem: block l_suppkey, sa1_7dig l_orderkey,
                      sa1_main l_partkey, persons l_partkey % 97 + 1,
                      share l_quantity * 0.02, year of l_shipdate
* income measure    = orders: sa1_7dig o_orderkey, year of o_orderdate,
                      weekly o_orderpriority, yearly o_orderstatus, value o_totalprice
* seifa index       = part: sa1_main p_partkey, type p_brand, measure p_type,
                      value p_retailprice
* cbsa2 / cbpostcodes = supplier x nation (sa2_5dig = nation key, postcode
                      = 3000 + nation key)
* area facts        = monthly order counts by customer nation
* workbooks         = one payment-type publication per lineitem ship month,
                      one jobseeker publication per order month, one rental
                      publication per order quarter (LGA = nation, suburb =
                      customer), laid out as ``sheet_rows``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.functions.period import period_to_date
from arealens.operators.selection import SEIFA_INDEX_TYPES, SEIFA_MEASURES, bounded_broadcast, dealt, staged

from arealens.plans.payment_types import payment_period

# Money and shares are exact decimals (as a numeric database column would
# be): sums are then exact, and round() meets a true .5 tie the same way in
# every engine and every summation order.
MONEY = "decimal(12,2)"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_nation(spark, d) -> DataFrame:
    """supplier x nation x region (dimension-to-dimension joins: small on both
    sides, planned by AQE from measured sizes)."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .drop("n_nationkey", "n_regionkey", "r_regionkey"))


def customer_nation(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).drop("n_nationkey")


def _txt(c) -> F.Column:
    return F.col(c).cast("string")


# ------------------------------------------------------------ selections --

def region_selections(spark, d) -> DataFrame:
    """(selection_id, block_id): every supplier, grouped by its region."""
    return supplier_nation(spark, d).select(F.col("r_name").alias("selection_id"),
                                            _txt("s_suppkey").alias("block_id"))


# ------------------------------------------------------------ concordances --

def cbsa1mb(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(_txt("l_suppkey").alias("block_id"), _txt("l_orderkey").alias("sa1_7dig"),
                     _txt("l_partkey").alias("sa1_main"),
                     (F.col("l_partkey") % 97 + 1).cast("bigint").alias("sa1_persons"),
                     (F.col("l_quantity").cast(MONEY) * F.lit(Decimal("0.02"))).alias("per_pct"),
                     F.year("l_shipdate").alias("year"))


def cbsa2(spark, d) -> DataFrame:
    return (supplier_nation(spark, d)
             .select(_txt("s_suppkey").alias("block_id"), _txt("s_nationkey").alias("sa2_5dig"),
                     (F.col("s_nationkey") + 200000000).cast("string").alias("sa2_main"),
                     F.col("n_name").alias("sa2_name")))


def cbpostcodes(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(_txt("s_suppkey").alias("block_id"),
                    (F.col("s_nationkey") + 3000).cast("string").alias("abs_postcode"))


# ------------------------------------------------------------ area facts --

def income_measure(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(_txt("o_orderkey").alias("sa1_7dig"), F.year("o_orderdate").alias("year"),
                    F.col("o_orderstatus").alias("eq_income_yearly"),
                    F.col("o_orderpriority").alias("eq_income_weekly"),
                    F.col("o_totalprice").cast(MONEY).alias("value"))


def seifa_index(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(_txt("p_partkey").alias("sa1_main"), F.col("p_brand").alias("seifaindextype"),
                    F.col("p_type").alias("seifa_measure"), F.col("p_retailprice").cast(MONEY).alias("value"))


def _orders_by_nation(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderstatus",
                                         "o_orderpriority", "o_totalprice")
    cn = bounded_broadcast(customer_nation(spark, d))
    return (o.join(cn, o.o_custkey == cn.c_custkey)
             .withColumn("m", F.trunc("o_orderdate", "month")))


def jobseeker_fact(spark, d) -> DataFrame:
    """(sa2_5dig, sa2_name, month "May 1996", series, value, month_date)."""
    x = _orders_by_nation(spark, d)
    return (x.groupBy(_txt("c_nationkey").alias("sa2_5dig"), F.col("n_name").alias("sa2_name"),
                      F.col("m"), F.col("o_orderpriority").alias("series"))
             .agg(F.count("*").cast("double").alias("value"))
             .select("sa2_5dig", "sa2_name", F.date_format("m", "MMMM yyyy").alias("month"),
                     "series", "value", F.col("m").cast("date").alias("month_date")))


def jobkeeper_fact(spark, d) -> DataFrame:
    """(postcode, month, applications)."""
    x = _orders_by_nation(spark, d)
    return (x.groupBy((F.col("c_nationkey") + 3000).cast("string").alias("postcode"), F.col("m"))
             .agg(F.count("*").alias("applications"))
             .select("postcode", F.date_format("m", "MMMM yyyy").alias("month"), "applications"))


def payment_types_pc_fact(spark, d) -> DataFrame:
    """(postcode, quarter "May-1996", series, value, month_date)."""
    x = _orders_by_nation(spark, d)
    return (x.groupBy((F.col("c_nationkey") + 3000).cast("string").alias("postcode"), F.col("m"),
                      F.col("o_orderstatus").alias("series"))
             .agg(F.count("*").cast("double").alias("value"))
             .select("postcode", F.date_format("m", "MMMM-yyyy").alias("quarter"), "series",
                     "value", F.col("m").cast("date").alias("month_date")))


def payment_types_sa2_fact(spark, d) -> DataFrame:
    """(sa2_5dig, sa2_name, quarter, series, value, month_date)."""
    x = _orders_by_nation(spark, d)
    return (x.groupBy(_txt("c_nationkey").alias("sa2_5dig"), F.col("n_name").alias("sa2_name"),
                      F.col("m"), F.col("o_orderstatus").alias("series"))
             .agg(F.count("*").cast("double").alias("value"))
             .select("sa2_5dig", "sa2_name", F.date_format("m", "MMMM-yyyy").alias("quarter"),
                     "series", "value", F.col("m").cast("date").alias("month_date")))


def sa2_salm_fact(spark, d) -> DataFrame:
    """(sa2_main, quarter "May 1996", series, value)."""
    x = _orders_by_nation(spark, d)
    return (x.groupBy((F.col("c_nationkey") + 200000000).cast("string").alias("sa2_main"),
                      F.col("m"), F.col("o_orderpriority").alias("series"))
             .agg(F.count("*").cast("double").alias("value"))
             .select("sa2_main", F.date_format("m", "MMMM yyyy").alias("quarter"), "series", "value"))


# ------------------------------------------------------------ publications --

def payment_url(month_col) -> F.Column:
    """File name of a payment-type publication, in the publishers' varying
    spellings: "dec-1996", "sept1996", "march1996", "may-1996"."""
    m = F.col(month_col)
    full = F.lower(F.date_format(m, "MMMM"))
    yyyy = F.date_format(m, "yyyy")
    mon = F.month(m)
    token = (F.when(mon == 12, F.concat(F.lit("dec-"), yyyy))
              .when(mon == 9, F.concat(F.lit("sept"), yyyy))
              .when(mon == 3, F.concat(full, yyyy))
              .otherwise(F.concat(full, F.lit("-"), yyyy)))
    return F.concat(F.lit("https://data.example.org/dss-demographics-"), token, F.lit(".xlsx"))


def _sheet_row(url, name, no, row_no, cells) -> list:
    def lit(v):
        return v if isinstance(v, F.Column) else F.lit(v)
    return [url.alias("source_url"), lit(name).cast("string").alias("sheet_name"),
            lit(no).cast("int").alias("sheet_no"), row_no.cast("int").alias("row_no"),
            cells.alias("cells")]


def marked_count(n) -> F.Column:
    """Published count cell: "<5" for 1-4, the count otherwise."""
    return F.when((n >= 1) & (n <= 4), F.lit("<5")).otherwise(n.cast("string"))


# Fixed values of the invented payment-type workbook: series per return flag.
PAYMENT_SERIES = (("A", "Age Pension"), ("N", "Health Care Card"),
                  ("R", "Commonwealth Seniors Health Card"))


def payment_type_sheets(spark, d) -> DataFrame:
    """Payment-type workbooks: three sheets (SA2, LGA, Postcode) per ship month."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag", "l_shipdate")
    sn = bounded_broadcast(supplier_nation(spark, d).drop("r_name"))
    x = (li.join(sn, li.l_suppkey == sn.s_suppkey)
           .withColumn("m", F.trunc("l_shipdate", "month")))
    counts = [F.count_if(F.col("l_returnflag") == f).alias(f) for f, _ in PAYMENT_SERIES]
    header_series = [F.lit(sname) for _, sname in PAYMENT_SERIES]

    def body(keys, code, name, sheet, no, row_key):
        g = x.groupBy("m", *keys).agg(*counts)
        cells = F.array(code, *([name] if name is not None else []),
                        *[marked_count(F.col(f)) for f, _ in PAYMENT_SERIES])
        return g.select(*_sheet_row(payment_url("m"), sheet, no, F.col(row_key) + 10, cells))

    sa2 = body(["l_suppkey", "s_name"], _txt("l_suppkey"), F.col("s_name"), "By SA2", 1, "l_suppkey")
    lga = body(["s_nationkey", "n_name"], (F.col("s_nationkey") + 19990).cast("string"),
               F.col("n_name"), "By LGA", 2, "s_nationkey")
    pc = body(["l_partkey"], _txt("l_partkey"), None, "By Postcode", 3, "l_partkey")
    # layout rows of the three sheets of every publication: two title rows,
    # the header, a footnote without an area code
    months = li.select(F.trunc("l_shipdate", "month").alias("m")).distinct()
    nul = F.lit(None).cast("string")

    def lay(name, no, r, *cells):
        return F.struct(F.lit(name).alias("name"), F.lit(no).alias("no"), F.lit(r).alias("r"),
                        F.array(*cells).alias("c"))

    layout = []
    for sheet, no, ids in (("By SA2", 1, ["SA2", "SA2 Name"]), ("By LGA", 2, ["LGA", "LGA name"]),
                           ("By Postcode", 3, ["Postcode"])):
        layout += [lay(sheet, no, 1, F.lit("DSS Payment Demographic Data")),
                   lay(sheet, no, 2, F.date_format("m", "MMMM yyyy")),
                   lay(sheet, no, 3, *[F.lit(i) for i in ids], *header_series),
                   lay(sheet, no, 4, nul, F.lit("Note: <5 means 1 to 4"))]
    meta = months.select("m", F.explode(F.array(*layout)).alias("x")).select(
        *_sheet_row(payment_url("m"), F.col("x.name"), F.col("x.no"), F.col("x.r"), F.col("x.c")))
    return sa2.unionByName(lga).unionByName(pc).unionByName(meta)


# Fixed values of the invented jobseeker workbook.
JOBSEEKER_HEADER = ("SA2", "SA2 Name", "JobSeeker Payment", "Youth Allowance (other)")


def jobseeker_sheets(spark, d) -> DataFrame:
    """Jobseeker workbooks: per order month, one row per customer nation."""
    x = _orders_by_nation(spark, d)
    url = F.concat(F.lit("https://data.example.org/jobseeker-payment-and-youth-allowance-recipients-"
                         "monthly-profile-"),
                   F.lower(F.date_format("m", "MMMM")), F.lit("-"), F.date_format("m", "yyyy"),
                   F.lit(".xlsx"))
    g = x.groupBy("m", "c_nationkey", "n_name").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("js"),
        F.count_if(F.col("o_orderstatus") == "O").alias("ya"))
    sheet, no = "Table 4 - By SA2", 4
    body = g.select(*_sheet_row(url, sheet, no, F.col("c_nationkey") + 20, F.array(
        _txt("c_nationkey"), F.col("n_name"), _txt("js"),
        F.when(F.col("ya") > 0, _txt("ya")))))
    months = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("m")).distinct()
    nul = F.lit(None).cast("string")

    def lay(name, no, r, *cells):
        return F.struct(F.lit(name).alias("name"), F.lit(no).alias("no"), F.lit(r).alias("r"),
                        F.array(*cells).alias("c"))

    header = [F.lit(h) for h in JOBSEEKER_HEADER]
    layout = [lay(sheet, no, r, F.lit(f"title {r}")) for r in range(1, 7)]
    layout += [lay(sheet, no, 7, *header), lay(sheet, no, 8, nul, F.lit("footnote")),
               # a second sheet that the exact-name pick must ignore
               lay("Table 3 - By State", 3, 7, *header)]
    meta = months.select("m", F.explode(F.array(*layout)).alias("x")).select(
        *_sheet_row(url, F.col("x.name"), F.col("x.no"), F.col("x.r"), F.col("x.c")))
    return body.unionByName(meta)


def _quarter_end(col) -> F.Column:
    return F.add_months(F.trunc(col, "quarter"), 2)


# An order is in two or three sheets, of two publications each, with two figures.
ORDERS_PER_TASK = 100_000
ROWS_PER_ORDER = 6


def rental_rows(spark, d) -> int:
    """At most so many rows have the rental workbooks of customers, but for their layout."""
    return ROWS_PER_ORDER * table(spark, d, "orders").count()


def rental_sheets(spark, d, geography: str = "lga") -> DataFrame:
    """Rental workbooks: per order quarter q, seven sheets (priority 1-5,
    status F, all orders); columns for the previous quarter and q, each a
    count and a price figure (the highest order price: exact and mergeable,
    so no group is gathered into one task); one row per area with data in
    either quarter."""
    x = _orders_by_nation(spark, d).withColumn("q", _quarter_end("o_orderdate"))
    if geography == "lga":
        area, area_key, url_word, remnant, cap = "n_name", "c_nationkey", "lga-quarterly", "LGA", True
    else:
        area, area_key, url_word, remnant, cap = "c_name", "c_custkey", "suburb", "Suburb", False
    # every order counts in its priority's sheet, in sheet 7, and in sheet 6 if fulfilled
    sheets = F.array(F.col("o_orderpriority").substr(1, 1).cast("int"),
                     F.when(F.col("o_orderstatus") == "F", F.lit(6)), F.lit(7))
    orders = x.select("q", F.col(area).alias("area"), F.col(area_key).alias("area_key"),
                      sheets.alias("sheets"), "o_totalprice")
    if geography != "lga":  # as many areas as customers: their orders are dealt once for both groupings
        orders = dealt(orders, "area_key", rows=table(spark, d, "orders").count(), per_task=ORDERS_PER_TASK)
    stats = (orders.select("q", "area", "area_key", F.explode("sheets").alias("sheet_no"), "o_totalprice")
              .filter(F.col("sheet_no").isNotNull())
              .groupBy("q", "area", "area_key", "sheet_no")
              .agg(F.count("*").alias("n"), F.max("o_totalprice").alias("med")))
    # each quarter's figures appear in its own publication (slot 2) and in
    # the next quarter's publication (slot 1)
    placed = (stats.withColumn("slot", F.explode(F.array(F.lit(1), F.lit(2))))
                   .withColumn("pub", F.when(F.col("slot") == 2, F.col("q"))
                               .otherwise(F.add_months("q", 3))))
    pubs = table(spark, d, "orders").select(_quarter_end("o_orderdate").alias("pub")).distinct()
    placed = placed.join(bounded_broadcast(pubs), "pub", "left_semi")

    def slot(k, c):
        return F.max(F.when(F.col("slot") == k, F.col(c)))

    rows = placed.groupBy("pub", "sheet_no", "area", "area_key").agg(
        slot(1, "n").alias("n1"), slot(1, "med").alias("m1"),
        slot(2, "n").alias("n2"), slot(2, "med").alias("m2"))
    month = F.date_format("pub", "MMMM")
    month = month if cap else F.lower(month)
    url = F.concat(F.lit(f"https://www.example.gov/rental-report-{url_word}-"), month,
                   F.lit("-quarter-"), F.date_format("pub", "yyyy"), F.lit(".xlsx"))

    def num(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("-"))

    nul = F.lit(None).cast("string")
    sname = F.concat(F.lit("Table "), F.col("sheet_no").cast("string"))
    body = rows.select(*_sheet_row(url, sname, F.col("sheet_no"), F.col("area_key") + 10,
                                   F.array(nul, F.col("area"), num("n1"), num("m1"), num("n2"), num("m2"))))
    # layout rows of every sheet of every publication: title, paired header,
    # column header, subtotal (removed by the load), footnote
    layout = pubs.select("pub", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("sheet_no"))
    prev_lab = F.date_format(F.add_months("pub", -3), "MMM yyyy")
    cur_lab = F.date_format("pub", "MMM yyyy")
    def lay(r, *cells):
        return F.struct(F.lit(r).alias("r"), F.array(*cells).alias("c"))

    meta = layout.select("pub", "sheet_no", F.explode(F.array(
        lay(1, F.lit("Rental Report"), nul),
        lay(2, nul, nul, prev_lab, nul, cur_lab, nul),
        lay(3, nul, F.lit(remnant), F.lit("Count"), F.lit("Median"), F.lit("Count"), F.lit("Median")),
        lay(5, nul, F.lit("Group Total"), F.lit("-"), F.lit("-"), F.lit("-"), F.lit("-")),
        lay(1 << 30, nul, nul, F.lit("Source: example")),
    )).alias("x"))
    meta = meta.select(*_sheet_row(url, sname, F.col("sheet_no"), F.col("x.r"), F.col("x.c")))
    return body.unionByName(meta)


def order_month_urls(spark, d) -> DataFrame:
    """One row per order month with the three publishers' URL spellings."""
    o = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("m")).distinct()
    q = F.date_format("m", "MMMM")
    return o.select(
        "m",
        payment_url("m").alias("payment_url"),
        F.concat(F.lit("https://data.example.org/jobseeker-monthly-profile-"), F.lower(q), F.lit("-"),
                 F.date_format("m", "yyyy"), F.lit(".xlsx")).alias("monthly_url"),
        F.concat(F.lit("https://www.example.gov/rental-report-suburb-"), q, F.lit("-quarter-"),
                 F.date_format("m", "yyyy"), F.lit(".xlsx")).alias("rental_url"))


# ------------------------------------------------- calls by table name --

# The blocks of a user's call, and the census years that order years stand for.
CALL_BLOCKS = ("1", "2", "3", "5", "8")
YEAR_SHIFT = 18


def named_tables(spark, d) -> dict:
    """Stored tables by name, with years and index types in the calls' domains
    (1998 stands for 2016; part number modulo 4 and 8 for index and measure)."""
    later = (F.col("year") + YEAR_SHIFT).cast("int")
    part = F.col("sa1_main").cast("bigint")

    def pick(values, n):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))

    return {
        "concord.cbsa1mb": cbsa1mb(spark, d).withColumn("year", later),
        "concord.cbsa2": cbsa2(spark, d), "concord.cbpostcodes": cbpostcodes(spark, d),
        "abs.sa1_tb_hh_equivalised_income": income_measure(spark, d).withColumn("year", later),
        "abs.sa1_seifa": seifa_index(spark, d).withColumn("seifaindextype", pick(SEIFA_INDEX_TYPES, part % 4))
                                              .withColumn("seifa_measure", pick(SEIFA_MEASURES, part % 8)),
        "dss.payment_types_qrt_pc": payment_types_pc_fact(spark, d),
        "dss.payment_types_qrt_sa2": payment_types_sa2_fact(spark, d)}


def odd_headers(spark, d) -> DataFrame:
    """(p_brand, p_size, header): raw labels with blanks, marks, accents and repeats."""
    p = table(spark, d, "part")
    fixed = [F.lit(None).cast("string"), F.col("p_brand"), F.col("p_brand"), F.lit(" "), F.lit("2003_31"),
             F.lit("2003_39"), F.lit("O'Neil Région %"), F.lit("JobSeeker Payment"), F.lit("job seeker payment")]
    return (p.groupBy("p_brand", "p_size").agg(F.array_sort(F.collect_list("p_type")).alias("types"))
             .select("p_brand", "p_size", F.concat(F.array(*fixed), F.col("types")).alias("header")))


def faulty_payment_sheets(spark, d) -> DataFrame:
    """Payment-type header rows with faults by ship month: February's file names
    have no period, April's SA2 sheets no code column, June's a second SA2
    sheet, August's no postcode sheet."""
    rows = payment_type_sheets(spark, d)
    months = table(spark, d, "lineitem").select(F.trunc("l_shipdate", "month").alias("m")).distinct()
    urls = bounded_broadcast(months.select(payment_url("m").alias("source_url"), F.month("m").alias("mon"),
                                           F.year("m").alias("y")))
    x = rows.join(urls, "source_url")
    x = x.filter((F.col("mon") != 8) | (F.col("sheet_name") != "By Postcode"))
    x = x.withColumn("source_url", F.when(F.col("mon") == 2, F.concat(
        F.lit("https://data.example.org/dss-demographics-x"), F.col("y").cast("string"), F.lit(".xlsx")))
        .otherwise(F.col("source_url")))
    x = x.withColumn("cells", F.when((F.col("mon") == 4) & (F.col("sheet_name") == "By SA2"), F.transform(
        "cells", lambda c: F.when(c == "SA2", F.lit("Code")).otherwise(c))).otherwise(F.col("cells")))
    twice = F.when((F.col("mon") == 6) & (F.col("sheet_name") == "By SA2"), F.array(F.lit(1), F.lit(9)))
    return (x.withColumn("sheet_no", F.explode(F.coalesce(twice, F.array("sheet_no"))))
             .select(*rows.columns))


# ------------------------------------------------ revisions, accounts, overlaps --

def payment_month(url="source_url") -> F.Column:
    return period_to_date(payment_period(url))


def of_months(rows: DataFrame, wanted: F.Column) -> DataFrame:
    """Rows of the publications that ``wanted`` (a condition on ``source_url``, such as on
    its ``payment_month``) holds of.  It is evaluated once per file name, not per row."""
    # cut: as a condition of the plan it would be pushed down to the rows, through the join as well
    names = staged(rows.select("source_url").distinct().withColumn("_wanted", wanted)).filter("_wanted")
    return rows.join(bounded_broadcast(names.select("source_url")), "source_url", "left_semi").select(*rows.columns)


def revised_payment_sheets(spark, d) -> DataFrame:
    """SA2 sheets of every month, and of every third month a revised publication:
    areas divisible by 11 are gone, areas divisible by 7 have another Age
    Pension figure, areas divisible by 13 have a second area beside them."""
    rows = staged(payment_type_sheets(spark, d).filter("sheet_name = 'By SA2'"))  # file names are read below
    key = F.try_element_at(F.col("cells"), F.lit(1)).try_cast("int")
    later = (of_months(rows, F.month(payment_month()) % 3 == 0)
                 .withColumn("source_url", F.regexp_replace("source_url", r"\.xlsx$", "-revised.xlsx"))
                 .withColumn("k", key).filter(F.col("k").isNull() | (F.col("k") % 11 != 0)))
    changed = F.concat(F.slice("cells", 1, 2), F.array(F.lit("1234")), F.slice("cells", 4, 2))
    beside = later.filter("k % 13 = 0").withColumn("row_no", F.col("row_no") + 100_000_000).withColumn(
        "cells", F.array(F.concat(F.lit("2x"), F.col("cells")[0]), F.col("cells")[1], F.lit("7"),
                         F.lit(None).cast("string"), F.lit("n.p.")))
    later = later.withColumn("cells", F.when(F.col("k") % 7 == 0, changed).otherwise(F.col("cells")))
    return rows.unionByName(later.drop("k")).unionByName(beside.drop("k"))


def noisy_payment_sheets(spark, d) -> DataFrame:
    """Payment-type workbooks with cells that can't be loaded: areas divisible by 9
    have a text, areas divisible by 10 an empty cell among their figures."""
    rows = payment_type_sheets(spark, d)
    key = F.try_element_at(F.col("cells"), F.lit(1)).try_cast("int")
    last = F.size("cells")
    text = F.concat(F.slice(F.col("cells"), F.lit(1), last - 1), F.array(F.lit("n.p.")))
    blank = F.concat(F.slice(F.col("cells"), F.lit(1), last - 1), F.array(F.lit(None).cast("string")))
    cells = F.when(key % 9 == 0, text).when(key % 10 == 0, blank).otherwise(F.col("cells"))
    return rows.withColumn("cells", cells)


def faulty_jobseeker_sheets(spark, d) -> DataFrame:
    """Jobseeker workbooks with faults by order month: February's file names have no
    period, April's sheet another name, June's another code column, August's
    workbook two such sheets, October's no series column."""
    rows = jobseeker_sheets(spark, d)
    month = period_to_date(F.replace(F.regexp_extract("source_url", "profile-(.*)[.]xlsx$", 1), F.lit("-"), F.lit(" ")))
    x = rows.withColumn("mon", F.month(month)).withColumn("y", F.year(month))
    own = F.col("sheet_no") == 4
    x = x.withColumn("source_url", F.when(F.col("mon") == 2, F.concat(
        F.lit("https://data.example.org/jobseeker-profile-"), F.col("y"), F.lit(".xlsx"))).otherwise(F.col("source_url")))
    x = x.withColumn("sheet_name", F.when((F.col("mon") == 4) & own, F.lit("Table 5 - By SA2")).otherwise(F.col("sheet_name")))
    header = own & (F.col("row_no") == 7)
    x = x.withColumn("cells", F.when((F.col("mon") == 6) & header, F.transform(
        "cells", lambda c: F.when(c == "SA2", F.lit("SA2 code")).otherwise(c)))
        .when((F.col("mon") == 10) & header, F.slice("cells", 1, 2)).otherwise(F.col("cells")))
    twice = F.when((F.col("mon") == 8) & own, F.array(F.lit(4), F.lit(9)))
    return x.withColumn("sheet_no", F.explode(F.coalesce(twice, F.array("sheet_no")))).select(*rows.columns)


# Fixed value: the classes of blocks that the overlapping selections are made of.
RINGS = 64
# A block is in 64 to 1,056 of them: few blocks make many rows of a task.
BLOCKS_PER_TASK = 1_000


def overlapping_selections(spark, d) -> DataFrame:
    """(selection_id, block_id): every interval of rings 0 to 63 is a selection (2,080
    of them, nested and overlapping); a supplier's ring is its number modulo 64."""
    s = dealt(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", per_task=BLOCKS_PER_TASK)
    ring = s.select(_txt("s_suppkey").alias("block_id"), (F.col("s_suppkey") % RINGS).cast("int").alias("ring"))
    low = ring.withColumn("low", F.explode(F.sequence(F.lit(0), F.col("ring"))))
    return (low.withColumn("high", F.explode(F.sequence(F.col("ring"), F.lit(RINGS - 1))))
               .select(F.concat_ws("-", "low", "high").alias("selection_id"), "block_id"))


def neighbour_concord(spark, d) -> DataFrame:
    """Concordance whose areas lie in neighbouring blocks: three suppliers share an area."""
    li = table(spark, d, "lineitem").select("l_suppkey", F.expr("l_suppkey div 3").alias("area"), F.year("l_shipdate").alias("year"))
    return li.select(_txt("l_suppkey").alias("block_id"), _txt("area").alias("sa1_main"),
                     (F.col("area") % 97 + 1).alias("sa1_persons"), "year")


def maker_index(spark, d) -> DataFrame:
    """Area index with few types: part prices by the first digit of their brand."""
    return (seifa_index(spark, d).withColumn("seifaindextype", F.substring("seifaindextype", 1, 7))
            .withColumn("seifa_measure", F.lit("SCORE")))


def header_typos(spark, d) -> DataFrame:
    """(m, header): cleaned header labels of order months as published, every third
    year with one of the two year marks that two sheets of one name carry."""
    o = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("m")).distinct()
    mark = F.when(F.year("m") % 3 == 0, F.lit("2003_31")).when(F.year("m") % 3 == 1, F.lit("2003_39")).otherwise(
        F.date_format("m", "yyyy"))
    return o.select(F.col("m").cast("date").alias("m"), F.concat(F.lower(F.date_format("m", "MMM")), F.lit("_"), mark).alias("header"))


def flat_customers(spark, d, folder: str) -> None:
    """One delimited text file per customer nation: two title rows, a header, a row
    per customer with a quoted name that holds the delimiter and quotes."""
    c = table(spark, d, "customer")
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""'), F.col("c_mktsegment"), F.lit('"""'))
    body = c.select("c_nationkey", F.col("c_custkey").alias("place"), F.concat_ws(
        ",", _txt("c_custkey"), quoted, F.when(F.col("c_custkey") % 5 != 0, _txt("c_custkey")).otherwise(F.lit(""))).alias("line"))
    titles = F.array(*[F.struct(F.lit(i - 3).cast("bigint").alias("place"), F.lit(t).alias("line"))
                       for i, t in enumerate(("Customers", "", "Key,Name,Again"))])
    top = c.select("c_nationkey").distinct().select("c_nationkey", F.explode(titles).alias("t")).select("c_nationkey", "t.*")
    (body.withColumn("place", F.col("place").cast("bigint")).unionByName(top)
         .repartition("c_nationkey").sortWithinPartitions("c_nationkey", "place")
         .select("c_nationkey", "line").write.partitionBy("c_nationkey").text(folder))
