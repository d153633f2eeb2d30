"""Registered queries: one per operator family, each over whole test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Column
names match the DuckDB statements in ``arealens.plans.oracle``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.functions.period import (PAYMENT_PERIOD_PATTERN, expand_header_month, extract_period,
                                       fix_header_typos, period_to_date, repair_period_label,
                                       sentence_case)
from arealens.functions.text import clean_header_names
from arealens.operators.area import apportioned_distribution, area_series, weighted_index
from arealens.operators.classes import overlapping_distribution, overlapping_index
from arealens.operators.clean import (cast_numbers, drop_labels, fill_numeric_nulls, keep_positive,
                                      keep_prefix, keep_present, lower_names, strip_markers_all)
from arealens.operators.gate import (current_period_rows, freshness_gate, new_periods_only,
                                     newest_period)
from arealens.operators.reshape import melt, tagged_union
from arealens.operators.revisions import revised_cells
from arealens.operators.selection import staged
from arealens.plans import bindings as b
from arealens.plans import catalog
from arealens.plans.jobseeker import jobseeker_month, jobseeker_quarantine, load_jobseeker
from arealens.plans.payment_types import (load_payment_types, load_payment_types_all, one_payment_geography,
                                          payment_account, payment_period, payment_quarantine)
from arealens.plans.publications import pending_publications
from arealens.plans.rental import load_rental, rental_period
from arealens.plans.sql import register_area_functions
from arealens.session import shared_folder
from arealens.sources.flat import read_flat_sheets
from arealens.sources.links import first_link, link_inventory
from arealens.sources.sheets import pick_sheets, sheets_per_source
from arealens.sources.store import ledger, read_loads, write_load

# Rank rules for order priorities: an overlapping label (first rule wins)
# and an unlisted one (no rank).
PRIORITY_RANKS = [(1, ["1-URGENT"]), (2, ["2-HIGH", "3-MEDIUM"]), (3, ["3-MEDIUM", "4-NOT SPECIFIED"])]


def q_apportioned_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Order totals apportioned to every region's suppliers (blocks) through lineitem shares."""
    return apportioned_distribution(b.income_measure(spark, d), b.cbsa1mb(spark, d),
                                    b.region_selections(spark, d), years=None)


def q_distribution_bucket_rank(spark, d):
    """The same, with the first-match bucket rank as a column."""
    return apportioned_distribution(b.income_measure(spark, d), b.cbsa1mb(spark, d),
                                    b.region_selections(spark, d), years=None,
                                    rank_rules=PRIORITY_RANKS, with_rank=True)


def q_weighted_index(spark, d):
    """Part prices weighted by persons over each region's distinct reachable parts."""
    return weighted_index(b.seifa_index(spark, d), b.cbsa1mb(spark, d), b.region_selections(spark, d),
                          index_types=None, measures=None, years=None)


def q_area_series_sa2(spark, d):
    """Monthly series of the nations (SA2s) each region's suppliers fall in."""
    return area_series(b.jobseeker_fact(spark, d), b.cbsa2(spark, d), b.region_selections(spark, d),
                       "jobseeker_monthly_payments_sa2")


def q_area_series_renamed_measure(spark, d):
    """Monthly counts by postcode, measure renamed to value."""
    return area_series(b.jobkeeper_fact(spark, d), b.cbpostcodes(spark, d),
                       b.region_selections(spark, d), "jobkeeper_monthly_applications_pc")


def q_area_series_postcode(spark, d):
    """Hyphen-labelled series by postcode."""
    return area_series(b.payment_types_pc_fact(spark, d), b.cbpostcodes(spark, d),
                       b.region_selections(spark, d), "payment_types_qrt_pc")


def q_area_series_sa2_quarterly(spark, d):
    """T3d: hyphen-labelled series by SA2 (fact key kept in the DISTINCT)."""
    return area_series(b.payment_types_sa2_fact(spark, d), b.cbsa2(spark, d),
                       b.region_selections(spark, d), "payment_types_qrt_sa2")


def q_area_series_main_key(spark, d):
    """T3e: series joined on the main SA2 code."""
    return area_series(b.sa2_salm_fact(spark, d), b.cbsa2(spark, d), b.region_selections(spark, d),
                       "sa2_salm")


def _part_text(spark, d, small) -> DataFrame:
    """Part sizes as published text: sizes below 5 written as ``small(size)``."""
    p = b.table(spark, d, "part")
    text = F.col("p_size").cast("string")
    size = F.when(F.col("p_size") < 5, small(text)).otherwise(text)
    return p.select("p_partkey", "p_name", "p_brand", "p_type", size.alias("p_size_text"),
                    F.col("p_retailprice").cast("string").alias("p_price_text"))


def q_strip_markers(spark, d):
    """E1/P7: '<' removed from every text column of part."""
    return strip_markers_all(_part_text(spark, d, lambda t: F.concat(F.lit("<"), t)))


def q_lenient_cast(spark, d):
    """Named text columns read as numbers ('n.p.' -> NULL)."""
    return cast_numbers(_part_text(spark, d, lambda t: F.lit("n.p.")), ["p_size_text", "p_price_text"])


def q_wide_to_long(spark, d):
    """Per supplier-month wide counts with '<5' markers, melted, region prefix, text positivity."""
    li = b.table(spark, d, "lineitem")
    area = F.concat(F.col("l_suppkey").cast("string"), F.lit("-"), F.date_format("l_shipdate", "yyyyMM"))
    flags = ["A", "N", "R"]
    wide = li.groupBy(area.alias("area")).agg(*[
        F.when(F.count_if(F.col("l_returnflag") == f) > 0,
               b.marked_count(F.count_if(F.col("l_returnflag") == f))).alias(f"flag_{f}") for f in flags])
    long = melt(wide, ["area"], [f"flag_{f}" for f in flags], "series", "value")
    long = strip_markers_all(long, columns=["value"])
    long = keep_prefix(long, "area", "2")
    return keep_positive(long, "value", compare="text")


def q_paired_header_long(spark, d):
    """Rental workbooks melted for every period in the paired header."""
    return load_rental(b.rental_sheets(spark, d, "lga"), "lga", current_only=False)


def q_tagged_union(spark, d):
    """Two frames of different shape stacked by name with a tag."""
    li = b.table(spark, d, "lineitem")
    small = li.filter(F.col("l_quantity") <= 10).groupBy("l_returnflag").agg(F.count("*").alias("n"))
    every = li.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    return tagged_union({"1 bedroom flat": small, "All properties": every})


def q_drop_subtotals(spark, d):
    """rollup subtotal and grand-total rows removed."""
    c = b.table(spark, d, "customer")
    n = b.table(spark, d, "nation")
    r = b.table(spark, d, "region")
    x = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    rolled = (x.rollup("r_name", "n_name").agg(F.count("*").alias("customers"))
               .select(F.col("r_name").alias("region"),
                       F.coalesce("n_name", F.lit("Group Total")).alias("area"), "customers"))
    return drop_labels(keep_present(rolled, "region"), "area", "Group Total")


def q_period_from_url(spark, d):
    """Period labels from three URL spellings per order month."""
    u = b.order_month_urls(spark, d)
    raw = extract_period("payment_url", PAYMENT_PERIOD_PATTERN)
    return u.select(F.col("m").cast("date").alias("month_date"), raw.alias("extracted"),
                    payment_period("payment_url").alias("quarter"),
                    jobseeker_month("monthly_url").alias("month"),
                    rental_period("rental_url").alias("rental_quarter"))


def q_period_repair(spark, d):
    """Label repair and header month expansion per order month."""
    u = b.order_month_urls(spark, d)
    token = sentence_case(extract_period("payment_url", PAYMENT_PERIOD_PATTERN))
    header = F.concat(F.lower(F.date_format("m", "MMM")), F.lit("_"), F.date_format("m", "yyyy"))
    return u.select(token.alias("label"), repair_period_label(token).alias("repaired"),
                    header.alias("header"),
                    fix_header_typos(expand_header_month(header)).alias("header_label"),
                    period_to_date(repair_period_label(token)).alias("month_date")).distinct()


def q_current_period_rows(spark, d):
    """Rows of the newest month only, distinct."""
    fact = b.jobseeker_fact(spark, d)
    newest = fact.agg(F.date_format(F.max("month_date"), "MMMM yyyy").alias("month"))
    return current_period_rows(fact.drop("month_date"), "month", newest)


def q_newest_period(spark, d):
    """A3/L1: newest stored period parsed from labels, with the unparsed count."""
    return newest_period(b.payment_types_pc_fact(spark, d), date_col=None, label_col="quarter")


def _candidates(spark, d):
    li = b.table(spark, d, "lineitem").select(F.trunc("l_shipdate", "month").alias("m")).distinct()
    return li.select(b.payment_url("m").alias("url"))


def q_freshness_gate(spark, d):
    """Ship-month publications gated on the newest stored label (contains)."""
    return freshness_gate(_candidates(spark, d), b.payment_types_pc_fact(spark, d), "url",
                          mode="contains")


def q_freshness_gate_later(spark, d):
    """L2: the same with the later-than rule on repaired periods."""
    c = _candidates(spark, d).withColumn("period", period_to_date(payment_period("url")))
    return freshness_gate(c, b.payment_types_pc_fact(spark, d), "url", period_col="period",
                          mode="later")


def q_append_new_periods(spark, d):
    """Loaded payment rows of periods not stored yet."""
    incoming = load_payment_types(b.payment_type_sheets(spark, d), "sa2")
    return new_periods_only(incoming, b.payment_types_sa2_fact(spark, d), "month_date")


def _host():
    return F.regexp_extract("url", r"^(https?://[^/]+)", 1)


def q_link_inventory(spark, d):
    """Page anchors containing 'the', prefixed with the page host."""
    return link_inventory(b.table(spark, d, "pages"), keep="the", prefix=_host(),
                          page_cols=("page_id", "url")).drop("url")


def q_link_inventory_scoped(spark, d):
    """Anchors inside each page's nav element."""
    return link_inventory(b.table(spark, d, "pages"), container="nav")


def q_newest_link(spark, d):
    """First link containing 'e' per page."""
    return first_link(b.table(spark, d, "pages"), keep="e")


def q_pending_publications(spark, d):
    """Newest link of every page, gated on the newest stored payment period."""
    return pending_publications(b.table(spark, d, "pages"), b.payment_types_pc_fact(spark, d),
                                keep="e", prefix=_host(), mode="contains")


def q_sheet_pick_check(spark, d):
    """Sheets picked per publication by the "SA" name pattern (must be 1)."""
    return sheets_per_source(pick_sheets(b.payment_type_sheets(spark, d), name_contains="SA"))


def q_payment_types_load_sa2(spark, d):
    """T4/T5: payment-type workbooks -> SA2 table."""
    return load_payment_types(b.payment_type_sheets(spark, d), "sa2")


def q_payment_types_load_lga(spark, d):
    """T5: payment-type workbooks -> LGA table."""
    return load_payment_types(b.payment_type_sheets(spark, d), "lga")


def q_payment_types_load_postcode(spark, d):
    """T5: payment-type workbooks -> postcode table."""
    return load_payment_types(b.payment_type_sheets(spark, d), "postcode")


def q_jobseeker_load(spark, d):
    """Jobseeker workbooks -> SA2 table (zeros and NULLs kept)."""
    return load_jobseeker(b.jobseeker_sheets(spark, d))


def q_rental_load_lga(spark, d):
    """Rental workbooks -> LGA table, current period."""
    return load_rental(b.rental_sheets(spark, d, "lga"), "lga")


def q_rental_load_suburb(spark, d):
    """Rental workbooks -> suburb table, current period."""
    return load_rental(b.rental_sheets(spark, d, "suburb"), "suburb", rows=b.rental_rows(spark, d))


def q_income_distribution_blocks(spark, d):
    """A literal block list and one year, tables by name."""
    return catalog.income_distribution(spark, list(b.CALL_BLOCKS), sel_year=2016, tables=b.named_tables(spark, d))


def q_seifa_index_blocks(spark, d):
    """A literal block list, one index, one measure and one year, tables by name."""
    return catalog.seifa_index(spark, list(b.CALL_BLOCKS), seifaindex="IRSD", measure="SCORE", sel_year=2016,
                               tables=b.named_tables(spark, d))


def q_area_time_series_blocks(spark, d):
    """A literal block list and a table chosen by name at run time."""
    return catalog.area_time_series(spark, list(b.CALL_BLOCKS), "payment_types_qrt_sa2", tables=b.named_tables(spark, d))


def q_clean_header_names(spark, d):
    """One cleaned name per header cell, with blanks, repeats, marks and accents."""
    return b.odd_headers(spark, d).select("p_brand", "p_size", F.posexplode(clean_header_names("header")).alias("pos", "name"))


def q_quarantined_sheets(spark, d):
    """Payment-type sheets that a load can't place, with the reason."""
    return payment_quarantine(b.faulty_payment_sheets(spark, d))


def _new_store(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/store-{uuid.uuid4().hex}"


def _payment_outputs(sheets) -> dict:
    every = staged(load_payment_types_all(sheets, with_source=True))
    return {sink: one_payment_geography(every, g) for g, sink in catalog.PAYMENT_SINKS.items()}


def q_load_ledger(spark, d):
    """The ledger after two loads (every other year, then all years) of the
    three payment tables: one row per table, period and publication, none twice."""
    store, sheets = _new_store(spark), staged(b.payment_type_sheets(spark, d))
    odd = b.of_months(sheets, F.year(b.payment_month()) % 2 == 1)
    for part in (odd, sheets):
        write_load(_payment_outputs(part), store)
    return ledger(spark, store).select("table_name", "month_date", "source_url", "rows", F.col("total").cast("double").alias("total"))


def q_newest_loaded(spark, d):
    """A3/L1: newest period of every payment table, from the ledger alone."""
    store = _new_store(spark)
    write_load(_payment_outputs(b.payment_type_sheets(spark, d)), store)
    return ledger(spark, store).groupBy("table_name").agg(F.max("month_date").alias("newest"), F.sum("rows").alias("rows"))


def q_revised_cells(spark, d):
    """Every SA2 cell of every publication against the one before it in its month."""
    rows = load_payment_types(b.revised_payment_sheets(spark, d), "sa2", with_source=True)
    return revised_cells(staged(rows), ["sa2_5dig", "sa2_name", "series"])


def q_latest_publications(spark, d):
    """The stored SA2 table after revised publications were loaded before the
    first ones: the last publication of every month, whatever the order."""
    store, sheets = _new_store(spark), staged(b.revised_payment_sheets(spark, d))
    revised = F.col("source_url").contains("revised")
    for part in (sheets.filter(revised), sheets.filter(~revised)):
        write_load({"sa2": load_payment_types(part, "sa2", with_source=True)}, store)
    return read_loads(spark, store, "sa2").drop("quarter")


def q_jobseeker_quarantine(spark, d):
    """Jobseeker publications that a load can't place, with the reason."""
    return jobseeker_quarantine(b.faulty_jobseeker_sheets(spark, d))


def q_load_account(spark, d):
    """What becomes of every landed payment cell, per publication and geography."""
    return payment_account(b.noisy_payment_sheets(spark, d))


def _sql_names(spark, d) -> dict:
    """Session views of the tables by name (dots replaced), for the SQL functions."""
    names = {}
    for name, df in b.named_tables(spark, d).items():
        names[name] = "area_" + name.replace(".", "_")
        df.createOrReplaceTempView(names[name])
    return names


def q_sql_income_distribution(spark, d):
    """T1 from SQL: a table function with a block list and one year."""
    register_area_functions(spark, _sql_names(spark, d), series=["payment_types_qrt_sa2"])
    return spark.sql("SELECT * FROM income_distribution(:blocks, array(2016))", args={"blocks": list(b.CALL_BLOCKS)})


def q_sql_seifa_index(spark, d):
    """T2 from SQL: a table function with a block list, an index, a measure and one year."""
    register_area_functions(spark, _sql_names(spark, d), series=["payment_types_qrt_sa2"])
    return spark.sql("SELECT * FROM seifa_index(:blocks, array('IRSD'), array('SCORE'), array(2016))",
                     args={"blocks": list(b.CALL_BLOCKS)})


def q_sql_area_series(spark, d):
    """T3/S5 from SQL: a table function with a block list."""
    register_area_functions(spark, _sql_names(spark, d), series=["payment_types_qrt_sa2"])
    return spark.sql("SELECT * FROM area_series_payment_types_qrt_sa2(:blocks) ORDER BY quarter, series, sa2_main",
                     args={"blocks": list(b.CALL_BLOCKS)})


def q_overlapping_selections(spark, d):
    """Order totals apportioned to 2,080 nested and overlapping selections."""
    return overlapping_distribution(b.income_measure(spark, d), b.cbsa1mb(spark, d), b.overlapping_selections(spark, d))


def q_overlapping_index(spark, d):
    """Part prices weighted by persons over the distinct areas of 2,080 selections."""
    return overlapping_index(b.maker_index(spark, d), b.neighbour_concord(spark, d), b.overlapping_selections(spark, d))


def q_flat_sheets(spark, d):
    """Delimited text files with title rows, read back as a landing table."""
    folder = _new_store(spark)
    b.flat_customers(spark, d, folder)
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)", 1)
    rows = read_flat_sheets(spark, folder, suffix=".txt", sheet_name=nation)
    return rows.select("sheet_name", "row_no", F.size("cells").alias("n_cells"), F.get("cells", F.lit(0)).alias("first"),
                       F.get("cells", F.lit(1)).alias("second"), F.get("cells", F.lit(2)).alias("third"))


def q_header_typos(spark, d):
    """Header labels with a published year mark, repaired and read as months."""
    h = b.header_typos(spark, d)
    label = fix_header_typos(expand_header_month("header"))
    return h.select("m", "header", label.alias("label"), period_to_date(label).alias("month_date"))


def q_lower_names(spark, d):
    """Column names in lower case, NULL numbers as 0."""
    c = b.table(spark, d, "customer")
    odd = c.select(F.col("c_custkey").alias("CustKey"), F.col("c_name").alias("NAME"),
                   F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("AcctBal"),
                   F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("Segment"))
    return lower_names(fill_numeric_nulls(odd))


QUERIES = {name[2:]: fn for name, fn in list(globals().items())
           if name.startswith("q_") and callable(fn)}
