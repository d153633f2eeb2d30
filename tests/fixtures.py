"""Hand-made rows in the reference's table shapes (FIXTURES.md section A)."""

from arealens import schemas as S


def rows(df, *cols):
    """Collected rows as tuples (in the frame's order)."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]


def cbsa1mb(spark):
    return spark.createDataFrame([
        ("73", "2100001", "20601100001", 400, 0.25, 2016),
        ("73", "2100001", "20601100001", 400, 0.25, 2016),
        ("74", "2100001", "20601100001", 400, 0.5, 2016),
        ("83", "2100002", "20601100002", 100, 1.0, 2016),
        ("73", "2100001", "20601100001", 380, 0.3, 2011),
    ], S.CBSA1MB)


def income(spark):
    return spark.createDataFrame([
        ("2100001", 2016, "Nil income", "Nil income", 8.0),
        ("2100001", 2016, "y-a", "800-999", 10.0),
        ("2100002", 2016, "y-a", "800-999", 4.0),
        ("2100002", 2016, "y-b", "Unknown label", 3.0),
        ("2100001", 2011, "y-c", "1-199", 20.0),
    ], S.SA1_INCOME)


def seifa(spark):
    return spark.createDataFrame([
        ("20601100001", "IRSD", "SCORE", 1000.0),
        ("20601100002", "IRSD", "SCORE", 900.0),
        ("20601100002", "IRSD", "RWAD", 5.0),
        ("20601100002", "IEO", "SCORE", None),
    ], S.SA1_SEIFA)


def cbsa2(spark):
    return spark.createDataFrame([
        ("73", "21105", "206041117", "Carlton"),
        ("74", "21105", "206041117", "Carlton"),
        ("83", "21110", "206041122", "Docklands"),
    ], S.CBSA2)


def cbpostcodes(spark):
    return spark.createDataFrame([("73", "3053"), ("74", "3053"), ("83", "3008")], S.CBPOSTCODES)


def sheet(url, name, no, rows):
    """sheet_rows records from a list of cell lists (row_no from 1)."""
    return [(url, name, no, i + 1, cells) for i, cells in enumerate(rows)]


PAYMENT_URL = "https://host/dss-demographics-december-2021.xlsx"
PAYMENT_SA2 = [
    ["title"], ["title 2"],
    ["SA2", "SA2 Name", "Age Pension", "Commonwealth Seniors Health Card", "Health Care Card"],
    ["21105", "Carlton", "120", "<5", "0"],
    ["21110", "Docklands", "n.p.", None, "7"],
    ["11001", "Elsewhere", "50", "50", "50"],
    [None, "footnote", None, None, None],
]

RENTAL_URL = "https://host/rental-report-quarterly-December-quarter-2021.xlsx"
RENTAL_SHEET = [
    ["title"],
    [None, None, "Sep 2021", None, "Dec 2021", None],
    [None, "LGA", "Count", "Median", "Count", "Median"],
    ["Inner", "Melbourne", "100", "400", "110", "410"],
    [None, "Yarra", "-", "-", "20", "395"],
    [None, "Group Total", "100", "400", "130", "405"],
    [None, None, "footnote", None, None, None],
]

JOBSEEKER_URL = "https://host/jobseeker-payment-and-youth-allowance-recipients-december-2021.xlsx"
JOBSEEKER_SHEET = [["t1"], ["t2"], ["t3"], ["t4"], ["t5"], ["t6"],
                   ["SA2", "SA2 Name", "JobSeeker Payment", "Youth Allowance (other)"],
                   ["21105", "Carlton", "0", None],
                   ["21110", "Docklands", "35", "<5"],
                   [None, "note", None, None]]


def sheet_rows(spark, records):
    return spark.createDataFrame(records, S.SHEET_ROWS)
