"""Period labels: find them in publication URLs, repair, parse and format.

Published files carry their period only in the file name, in several
spellings ("december-2021", "dec-2019", "march2014", "201509",
"December-quarter-2021").  Stored tables keep a text label plus a
first-of-month ``DateType``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the file-name patterns the publishers use. -------------
# Quarterly payment-type files (lower case; "dec" and "sept" abbreviations; one
# file named by its year-month number).
PAYMENT_PERIOD_PATTERN = (
    r"((january|february|march|april|may|june|july|august|september|october|november|december|dec|sept)-\d\d\d\d)"
    r"|((january|february|march|april|may|june|july|august|september|october|november|december|dec|sept)\d\d\d\d)"
    r"|201509"
)
# Monthly jobseeker files.
MONTHLY_PERIOD_PATTERN = (
    r"((january|february|march|april|may|june|july|august|september|october|november|december)-\d\d\d\d)"
)
# Quarterly rental report files.
RENTAL_PERIOD_PATTERN = (
    r"((March|June|September|December|march|june|september|december)-quarter-\d\d\d\d)"
)
# Month abbreviations used in file names and sheet headers.
MONTH_ABBREVIATIONS = {"dec": "December", "sept": "September"}
HEADER_MONTH_PREFIXES = [("mar_", "March "), ("jun_", "June "), ("sep_", "September "),
                         ("dec_", "December ")]
# Header labels that were mis-typed in the rental workbooks (after the month
# prefix is expanded): "2003_31" stands for 2002, "2003_39" for 2003.
HEADER_YEAR_TYPOS = [("2003_31", "2002"), ("2003_39", "2003")]
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_period(url, pattern: str = PAYMENT_PERIOD_PATTERN) -> Column:
    """First match of ``pattern`` in ``url``; NULL when nothing matches."""
    return F.regexp_substr(_c(url), F.lit(pattern))


def sentence_case(col) -> Column:
    """First character upper case, the rest lower case."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title_case(col) -> Column:
    """Every word capitalised."""
    return F.initcap(_c(col))


def repair_period_label(col) -> Column:
    """Canonical ``Month-YYYY`` label from any extracted spelling.

    "Dec-2019" -> "December-2019", "Sept-2019" -> "September-2019",
    "March2014" -> "March-2014", "201509" -> "September-2015".  Labels that are
    already canonical pass through; anything else is returned unchanged.
    """
    c = _c(col)
    word = F.regexp_extract(c, r"^([A-Za-z]+)-?(\d{4})$", 1)
    year = F.regexp_extract(c, r"^([A-Za-z]+)-?(\d{4})$", 2)
    month = F.coalesce(*[F.when(F.lower(word) == k, F.lit(v)) for k, v in MONTH_ABBREVIATIONS.items()],
                       word)
    yyyymm = F.try_to_date(c, "yyyyMM")
    return (F.when(c.rlike(r"^\d{6}$") & yyyymm.isNotNull(), F.date_format(yyyymm, "MMMM-yyyy"))
             .when(word != "", F.concat(month, F.lit("-"), year))
             .otherwise(c))


def period_to_date(col) -> Column:
    """Text label ("December 2019", "december-2019") -> first day of that month.

    Month names are matched case-insensitively; hyphen and space separators are
    both accepted.  Unparseable labels give NULL instead of an error.
    """
    return F.try_to_date(F.regexp_replace(_c(col), "-", " "), "MMMM yyyy")


def newest_label(date_col) -> Column:
    """Aggregate: lower-case label of the newest date ("december-2019")."""
    return F.lower(F.date_format(F.max(_c(date_col)), "MMMM-yyyy"))


def url_has_period(url, period) -> Column:
    """Literal (not regex) substring test of a period label in a URL."""
    return F.contains(_c(url), _c(period))


def expand_header_month(col) -> Column:
    """"sep_2021" -> "September 2021" (first occurrence of each prefix)."""
    c = _c(col)
    for short, full in HEADER_MONTH_PREFIXES:
        c = F.regexp_replace(c, "(?s)^(.*?)" + short, "$1" + full)
    return c


def fix_header_typos(col) -> Column:
    """Repair the known mis-typed year labels (every occurrence)."""
    c = _c(col)
    for bad, good in HEADER_YEAR_TYPOS:
        c = F.regexp_replace(c, bad, good)
    return c


# A publication's revision mark in its file name: "...-dec-2021-revised.xlsx" is
# revision 1 of its period, "...-v3.xlsx" revision 3, a plain name revision 0.
REVISION_PATTERN = r"(?i)[-_ .](?:v(?=[0-9])|(?:revised|revision|rev|updated|corrected)(?![a-z]))[-_ ]?([0-9]*)"


def revision_sql(url: str) -> str:
    """SQL text of a publication's revision number, read from its file name."""
    number = f"regexp_extract({url}, r'{REVISION_PATTERN}', 1)"
    return (f"CASE WHEN {url} RLIKE r'{REVISION_PATTERN}' "
            f"THEN coalesce(try_cast(nullif({number}, '') AS INT), 1) ELSE 0 END")


def publication_order(url: str = "source_url") -> F.Column:
    """Sortable order of the publications of one period: revision number, then name."""
    return F.struct(F.expr(revision_sql(url)).alias("revision"), F.col(url).alias("name"))
