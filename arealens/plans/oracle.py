"""DuckDB statements that compute each registered query independently.

They read the driver's views (region nation customer supplier part orders
lineitem events pages ...) and follow the bindings of
``arealens.plans.bindings`` directly, without the sheet landing model: areas are
reached with EXISTS and pre-summed persons, links by splitting pages at "<".
Period and label patterns of the publishers are fixed values on both sides.
"""

from __future__ import annotations

SEL = """sel AS (
  SELECT r_name AS selection_id, CAST(s_suppkey AS VARCHAR) AS block_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CBSA1MB = """cc1 AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS block_id, CAST(l_orderkey AS VARCHAR) AS sa1_7dig,
         CAST(l_partkey AS VARCHAR) AS sa1_main, CAST(l_partkey % 97 + 1 AS BIGINT) AS sa1_persons,
         CAST(l_quantity AS DECIMAL(12,2)) * 0.02 AS per_pct, CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem)"""

CBSA2 = """cc2 AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS block_id, CAST(s_nationkey AS VARCHAR) AS sa2_5dig,
         CAST(s_nationkey + 200000000 AS VARCHAR) AS sa2_main, n_name AS sa2_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

CBPC = """ccp AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS block_id, CAST(s_nationkey + 3000 AS VARCHAR) AS abs_postcode
  FROM supplier)"""

OBN = """obn AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice,
         c_nationkey, n_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS m
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


INCOME = """income AS (
  SELECT sel.selection_id, o_orderstatus AS eq_income_yearly, o_orderpriority AS eq_income_weekly,
         CAST(o_totalprice AS DECIMAL(12,2)) * cc1.per_pct AS dwellings, cc1.year
  FROM cc1 JOIN sel ON cc1.block_id = sel.block_id
  JOIN orders ON cc1.sa1_7dig = CAST(o_orderkey AS VARCHAR) AND cc1.year = year(o_orderdate))"""

APPORTIONED = _with(SEL, CBSA1MB, INCOME) + """
SELECT selection_id, eq_income_weekly, eq_income_yearly, CAST(round(sum(dwellings)) AS DOUBLE) AS value, year
FROM income GROUP BY selection_id, eq_income_yearly, eq_income_weekly, year"""

BUCKET_RANK = _with(SEL, CBSA1MB, INCOME) + """
SELECT selection_id, eq_income_weekly, eq_income_yearly, CAST(round(sum(dwellings)) AS DOUBLE) AS value, year,
       CAST(CASE WHEN eq_income_weekly = '1-URGENT' THEN 1
                 WHEN eq_income_weekly = '2-HIGH' OR eq_income_weekly = '3-MEDIUM' THEN 2
                 WHEN eq_income_weekly = '3-MEDIUM' OR eq_income_weekly = '4-NOT SPECIFIED' THEN 3
            END AS INTEGER) AS bucket_rank
FROM income GROUP BY selection_id, eq_income_yearly, eq_income_weekly, year"""

# Persons are summed per region, year and part first; an index value then counts once per part.
WEIGHTED = """
WITH reached AS (
  SELECT DISTINCT n_regionkey AS region, l_partkey AS part, year(l_shipdate) AS y
  FROM lineitem, supplier, nation WHERE s_suppkey = l_suppkey AND n_nationkey = s_nationkey),
persons AS (SELECT region, y, part, part % 97 + 1 AS p FROM reached),
sums AS (
  SELECT region, y, p_brand, p_type, sum(CAST(p_retailprice AS DECIMAL(12,2)) * p) AS top, sum(p) AS bottom
  FROM persons JOIN part ON p_partkey = part WHERE p_retailprice IS NOT NULL GROUP BY ALL)
SELECT (SELECT r_name FROM region WHERE r_regionkey = sums.region) AS selection_id, p_brand AS seifaindextype,
       p_type AS seifa_measure, CAST(round(top / nullif(bottom, 0)) AS DOUBLE) AS value, CAST(y AS INTEGER) AS year
FROM sums"""

# One row per nation with a supplier (blocks reach their nation), then a count per month of its customers' orders.
_COUNTS = """
WITH months AS (
  SELECT c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, {series} AS series, count(*) AS n
  FROM customer, orders WHERE o_custkey = c_custkey GROUP BY ALL),
areas AS (
  SELECT n_nationkey AS nation, n_name AS label, (SELECT r_name FROM region WHERE r_regionkey = n_regionkey) AS sel
  FROM nation WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey))
SELECT sel AS selection_id, {columns} FROM areas JOIN months USING (nation)"""

_SA2_MAIN = "CAST(nation + 200000000 AS VARCHAR) AS sa2_main, label AS sa2_name"
_POSTCODE = "CAST(nation + 3000 AS VARCHAR) AS postcode"
AS_SA2 = _COUNTS.format(series="o_orderpriority",
                        columns=f"{_SA2_MAIN}, m AS month, series, CAST(n AS DOUBLE) AS value")
AS_JOBKEEPER = _COUNTS.format(series="NULL", columns=f"{_POSTCODE}, m AS month, n AS value")
AS_POSTCODE = _COUNTS.format(series="o_orderstatus",
                             columns=f"{_POSTCODE}, m AS quarter, series, CAST(n AS DOUBLE) AS value")
AS_SA2_Q = _COUNTS.format(series="o_orderstatus",
                          columns=f"{_SA2_MAIN}, m AS quarter, series, CAST(n AS DOUBLE) AS value")
AS_MAIN = _COUNTS.format(series="o_orderpriority",
                         columns=f"{_SA2_MAIN}, m AS quarter, series, CAST(n AS DOUBLE) AS value")

STRIP = """
SELECT p_partkey, replace(p_name, '<', '') AS p_name, replace(p_brand, '<', '') AS p_brand,
       replace(p_type, '<', '') AS p_type,
       replace(CASE WHEN p_size < 5 THEN '<' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END,
               '<', '') AS p_size_text,
       replace(CAST(p_retailprice AS VARCHAR), '<', '') AS p_price_text
FROM part"""

LENIENT = """
SELECT p_partkey, p_name, p_brand, p_type,
       TRY_CAST(CASE WHEN p_size < 5 THEN 'n.p.' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS p_size_text,
       CAST(p_retailprice AS DOUBLE) AS p_price_text
FROM part"""

WIDE_TO_LONG = """
WITH w AS (
  SELECT CAST(l_suppkey AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m') AS area,
         count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r
  FROM lineitem GROUP BY 1),
cells AS (
  SELECT area, 'flag_A' AS series, a AS c FROM w UNION ALL
  SELECT area, 'flag_N', n FROM w UNION ALL
  SELECT area, 'flag_R', r FROM w),
txt AS (
  SELECT area, series,
         replace(CASE WHEN c = 0 THEN NULL WHEN c BETWEEN 1 AND 4 THEN '<5' ELSE CAST(c AS VARCHAR) END,
                 '<', '') AS value
  FROM cells)
SELECT area, series, value FROM txt WHERE area LIKE '2%' AND value > '0'"""

# Rental publications: per quarter end q, areas with data in q or the quarter
# before; one row per (area, sheet, quarter, series) with the figure or NULL.
RENTAL_BASE = OBN + """,
x AS (
  SELECT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE) AS q, {area} AS area,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS sheet_no, o_totalprice FROM ({src})
  UNION ALL
  SELECT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE), {area}, 6, o_totalprice
  FROM ({src}) WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE), {area}, 7, o_totalprice
  FROM ({src})),
s AS (SELECT q, area, sheet_no, count(*) AS n, max(o_totalprice) AS med
      FROM x GROUP BY q, area, sheet_no),
pubs AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE) AS pub FROM orders),
rowkeys AS (
  SELECT DISTINCT k.pub, k.area, k.sheet_no FROM (
    SELECT q AS pub, area, sheet_no FROM s
    UNION ALL SELECT CAST(q + INTERVAL 3 MONTH AS DATE), area, sheet_no FROM s) k
  WHERE k.pub IN (SELECT pub FROM pubs)),
slots AS (
  SELECT pub, area, sheet_no, pub AS quarter_date FROM rowkeys
  {prev_slot}),
dw(sheet_no, dwelling_type) AS (VALUES (1, '1 bedroom flat'), (2, '2 bedroom flat'), (3, '3 bedroom flat'),
  (4, '2 bedroom house'), (5, '3 bedroom house'), (6, '4 bedroom house'), (7, 'All properties')),
out AS (
  SELECT sl.area, CAST(s.n AS DOUBLE) AS value, sl.quarter_date, 'No. New Lettings' AS series, sl.sheet_no
  FROM slots sl LEFT JOIN s ON s.q = sl.quarter_date AND s.area = sl.area AND s.sheet_no = sl.sheet_no
  UNION ALL
  SELECT sl.area, CAST(s.med AS DOUBLE), sl.quarter_date, 'Moving Annual Median', sl.sheet_no
  FROM slots sl LEFT JOIN s ON s.q = sl.quarter_date AND s.area = sl.area AND s.sheet_no = sl.sheet_no)
SELECT DISTINCT out.area AS {geo}, out.value, strftime(out.quarter_date, '%B %Y') AS quarter, out.series,
       dw.dwelling_type, out.quarter_date AS month_date
FROM out JOIN dw ON out.sheet_no = dw.sheet_no"""

_PREV = "UNION ALL SELECT pub, area, sheet_no, CAST(pub - INTERVAL 3 MONTH AS DATE) FROM rowkeys"
_LGA_SRC = "SELECT o_orderdate, o_orderpriority, o_orderstatus, o_totalprice, n_name FROM obn"
_SUB_SRC = ("SELECT o_orderdate, o_orderpriority, o_orderstatus, o_totalprice, c_name "
            "FROM orders JOIN customer ON o_custkey = c_custkey")

RENTAL_LGA = "WITH " + RENTAL_BASE.format(area="n_name", src=_LGA_SRC, prev_slot="", geo="lga")
RENTAL_SUBURB = "WITH " + RENTAL_BASE.format(area="c_name", src=_SUB_SRC, prev_slot="", geo="suburb")
PAIRED = "WITH " + RENTAL_BASE.format(area="n_name", src=_LGA_SRC, prev_slot=_PREV, geo="lga")

TAGGED = """
SELECT l_returnflag, count(*) AS n, CAST(NULL AS DOUBLE) AS qty, '1 bedroom flat' AS dwelling_type
FROM lineitem WHERE l_quantity <= 10 GROUP BY l_returnflag
UNION ALL
SELECT l_returnflag, count(*), sum(l_quantity), 'All properties' FROM lineitem GROUP BY l_returnflag"""

SUBTOTALS = """
WITH r AS (
  SELECT r_name AS region, coalesce(n_name, 'Group Total') AS area, count(*) AS customers
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ROLLUP (r_name, n_name))
SELECT region, area, customers FROM r WHERE region IS NOT NULL AND area != 'Group Total'"""

# token in the payment-type file name, as the publishers spell it
_TOKEN = """CASE WHEN month(m) = 12 THEN 'dec-' || strftime(m, '%Y')
                WHEN month(m) = 9 THEN 'sept' || strftime(m, '%Y')
                WHEN month(m) = 3 THEN lower(strftime(m, '%B')) || strftime(m, '%Y')
                ELSE lower(strftime(m, '%B')) || '-' || strftime(m, '%Y') END"""

PERIOD_FROM_URL = f"""
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
SELECT m AS month_date, {_TOKEN} AS extracted, strftime(m, '%B-%Y') AS quarter,
       strftime(m, '%B %Y') AS month,
       CASE WHEN month(m) IN (3, 6, 9, 12) THEN strftime(m, '%B %Y') END AS rental_quarter
FROM mm"""

PERIOD_REPAIR = f"""
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
t AS (SELECT m, {_TOKEN} AS token FROM mm)
SELECT DISTINCT upper(substr(token, 1, 1)) || substr(token, 2) AS label, strftime(m, '%B-%Y') AS repaired,
       lower(strftime(m, '%b')) || '_' || strftime(m, '%Y') AS header,
       CASE WHEN month(m) = 3 THEN 'March ' WHEN month(m) = 6 THEN 'June '
            WHEN month(m) = 9 THEN 'September ' WHEN month(m) = 12 THEN 'December '
            ELSE lower(strftime(m, '%b')) || '_' END || strftime(m, '%Y') AS header_label,
       m AS month_date
FROM t"""

CURRENT_ROWS = _with(OBN) + """,
fact AS (SELECT CAST(c_nationkey AS VARCHAR) AS sa2_5dig, n_name AS sa2_name, m,
                o_orderpriority AS series, CAST(count(*) AS DOUBLE) AS value
         FROM obn GROUP BY ALL)
SELECT DISTINCT sa2_5dig, sa2_name, strftime(m, '%B %Y') AS month, series, value
FROM fact WHERE m = (SELECT max(m) FROM fact)"""

NEWEST = """
SELECT lower(strftime(max(date_trunc('month', o_orderdate)), '%B-%Y')) AS newest,
       CAST(max(date_trunc('month', o_orderdate)) AS DATE) AS newest_date, CAST(0 AS BIGINT) AS unparsed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_CANDIDATES = f"""cand AS (
  SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem),
urls AS (SELECT m, 'https://data.example.org/dss-demographics-' || {_TOKEN} || '.xlsx' AS url FROM cand),
newest AS (SELECT CAST(max(date_trunc('month', o_orderdate)) AS DATE) AS d FROM orders
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

GATE = "WITH " + _CANDIDATES + """
SELECT url, lower(strftime(d, '%B-%Y')) AS newest, contains(url, lower(strftime(d, '%B-%Y'))) AS already_loaded
FROM urls, newest"""

GATE_LATER = "WITH " + _CANDIDATES + """
SELECT url, m AS period, d AS newest_date, m <= d AS already_loaded FROM urls, newest"""

_PAY = """pay AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, {code} AS code, {name} AS name,
         count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL),
pl AS (
  SELECT m, code, name, 'Age Pension' AS series, a AS c FROM pay UNION ALL
  SELECT m, code, name, 'Health Care Card', n FROM pay UNION ALL
  SELECT m, code, name, 'Commonwealth Seniors Health Card', r FROM pay)"""


def _payment(code, name, code_col, name_col, prefix, extra_where=""):
    names = f", name AS {name_col}" if name_col else ""
    return "WITH " + _PAY.format(code=code, name=name) + f"""
SELECT code AS {code_col}{names}, strftime(m, '%B-%Y') AS quarter, series,
       CAST(CASE WHEN c BETWEEN 1 AND 4 THEN 5 ELSE c END AS DOUBLE) AS value, m AS month_date
FROM pl WHERE c > 0 AND code LIKE '{prefix}%' {extra_where}"""


PAY_SA2 = _payment("CAST(l_suppkey AS VARCHAR)", "s_name", "sa2_5dig", "sa2_name", "2")
PAY_LGA = _payment("CAST(s_nationkey + 19990 AS VARCHAR)", "n_name", "lga_code", "lga_name", "2")
PAY_PC = _payment("CAST(l_partkey AS VARCHAR)", "NULL", "postcode", None, "3")
APPEND_NEW = _payment("CAST(l_suppkey AS VARCHAR)", "s_name", "sa2_5dig", "sa2_name", "2",
                      "AND m NOT IN (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) "
                      "FROM orders JOIN customer ON o_custkey = c_custkey "
                      "JOIN nation ON c_nationkey = n_nationkey)")

JOBSEEKER = _with(OBN) + """,
g AS (SELECT m, c_nationkey, n_name, count(*) FILTER (WHERE o_orderstatus = 'F') AS js,
             count(*) FILTER (WHERE o_orderstatus = 'O') AS ya
      FROM obn GROUP BY ALL)
SELECT CAST(c_nationkey AS VARCHAR) AS sa2_5dig, n_name AS sa2_name, strftime(m, '%B %Y') AS month,
       'JobSeeker Payment' AS series, CAST(js AS DOUBLE) AS value, m AS month_date FROM g
UNION ALL
SELECT CAST(c_nationkey AS VARCHAR), n_name, strftime(m, '%B %Y'), 'Youth Allowance Payments',
       CASE WHEN ya > 0 THEN CAST(ya AS DOUBLE) END, m FROM g"""

# Pages are split at "<"; an anchor is a piece that starts with the tag name.
_LINKS = """pieces AS (
  SELECT page_id, url, unnest(p) AS piece, unnest(generate_series(1, len(p))) AS n
  FROM (SELECT page_id, url, string_split(html, '<') AS p FROM pages)),
anchors AS (
  SELECT page_id, url, n,
         replace(split_part(split_part(piece, 'href="', 2), '"', 1), '&amp;', '&') AS href
  FROM pieces WHERE starts_with(piece, 'a ') AND contains(split_part(piece, '>', 1), 'href="')),
links AS (
  SELECT page_id, url, href, n, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) AS INTEGER) AS link_no
  FROM anchors)"""

LINKS = "WITH " + _LINKS + """
SELECT page_id, link_no, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || href AS href
FROM links WHERE contains(href, 'the')"""

# Inside a nav: more opening than closing tags of it before the anchor.
LINKS_SCOPED = "WITH " + _LINKS + """,
marks AS (
  SELECT page_id, n, CASE WHEN starts_with(piece, 'nav>') OR starts_with(piece, 'nav ') THEN 1 ELSE -1 END AS step
  FROM pieces WHERE starts_with(piece, 'nav>') OR starts_with(piece, 'nav ') OR starts_with(piece, '/nav>')),
inside AS (
  SELECT l.page_id, l.href, l.n FROM links l JOIN marks m ON m.page_id = l.page_id AND m.n < l.n
  GROUP BY l.page_id, l.href, l.n HAVING sum(m.step) > 0)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) AS INTEGER) AS link_no, href FROM inside"""

NEWEST_LINK = "WITH " + _LINKS + """
SELECT page_id, href, link_no FROM links WHERE contains(href, 'e')
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY link_no) = 1"""

SHEET_PICK = f"""
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem)
SELECT 'https://data.example.org/dss-demographics-' || {_TOKEN} || '.xlsx' AS source_url,
       CAST(1 AS BIGINT) AS n_sheets
FROM mm"""

PENDING = "WITH " + _LINKS + """,
label AS (SELECT lower(strftime(max(o_orderdate), '%B-%Y')) AS newest FROM orders
          WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation)))
SELECT page_id, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || href AS href, link_no, newest,
       strpos(split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || href, newest) > 0 AS already_loaded
FROM links, label WHERE contains(href, 'e')
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY link_no) = 1"""

# The calls by name: blocks 1, 2, 3, 5, 8; 1998 stands for 2016.
INCOME_BLOCKS = """
SELECT o_orderpriority AS eq_income_weekly, o_orderstatus AS eq_income_yearly,
       CAST(round(sum(CAST(o_totalprice AS DECIMAL(12,2)) * share)) AS DOUBLE) AS value, 2016 AS year
FROM (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(12,2)) * 0.02) AS share FROM lineitem
      WHERE l_suppkey IN (1, 2, 3, 5, 8) AND year(l_shipdate) = 1998 GROUP BY 1)
JOIN orders ON o_orderkey = l_orderkey WHERE year(o_orderdate) = 1998 GROUP BY 1, 2"""

SEIFA_BLOCKS = """
SELECT 'IRSD' AS seifaindextype, 'SCORE' AS seifa_measure,
       CAST(round(sum(CAST(p_retailprice AS DECIMAL(12,2)) * (p_partkey % 97 + 1)) / sum(p_partkey % 97 + 1)) AS DOUBLE) AS value,
       2016 AS year
FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 8 = 0 AND p_retailprice IS NOT NULL AND p_partkey IN (
  SELECT l_partkey FROM lineitem WHERE l_suppkey IN (1, 2, 3, 5, 8) AND year(l_shipdate) = 1998)
HAVING count(*) > 0"""

SERIES_BLOCKS = """
SELECT CAST(c_nationkey + 200000000 AS VARCHAR) AS sa2_main, (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS sa2_name,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS quarter, o_orderstatus AS series, CAST(count(*) AS DOUBLE) AS value
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_suppkey IN (1, 2, 3, 5, 8)) GROUP BY ALL"""

HEADER_NAMES = r"""
WITH cells AS (
  SELECT p_brand, p_size, unnest(h) AS cell, unnest(generate_series(1, len(h))) AS i FROM (
    SELECT p_brand, p_size, [NULL, p_brand, p_brand, ' ', '2003_31', '2003_39', 'O' || chr(39) || 'Neil Région %', 'JobSeeker Payment',
                             'job seeker payment'] || list(p_type ORDER BY p_type) AS h
    FROM part GROUP BY p_brand, p_size)),
plain AS (
  SELECT *, trim(cell) AS t, regexp_replace(regexp_replace(replace(strip_accents(trim(cell)), chr(39), ''),
    '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g') AS c FROM cells),
snake AS (
  SELECT *, trim(regexp_replace(replace(replace(lower(c), '%', '_percent_'), '#', '_number_'), '[^a-z0-9]+', '_', 'g'), '_') AS s,
         count(*) OVER (PARTITION BY p_brand, p_size, t) AS n FROM plain),
base AS (
  SELECT *, CASE WHEN coalesce(s, '') = '' THEN 'x' || i
                 ELSE (CASE WHEN s[1] BETWEEN '0' AND '9' THEN 'x' ELSE '' END) || s || (CASE WHEN n > 1 THEN '_' || i ELSE '' END) END AS f
  FROM snake),
numbered AS (
  SELECT *, f || (CASE WHEN row_number() OVER w > 1 THEN '_' || row_number() OVER w ELSE '' END) AS g
  FROM base WINDOW w AS (PARTITION BY p_brand, p_size, f ORDER BY i))
SELECT p_brand, p_size, CAST(i - 1 AS INTEGER) AS pos,
       g || (CASE WHEN row_number() OVER (PARTITION BY p_brand, p_size, g ORDER BY i) > 1 THEN '_p' || i ELSE '' END) AS name
FROM numbered"""

QUARANTINE = f"""
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem),
u AS (SELECT m, CASE WHEN month(m) = 2 THEN 'https://data.example.org/dss-demographics-x' || year(m) || '.xlsx'
                     ELSE 'https://data.example.org/dss-demographics-' || {_TOKEN} || '.xlsx' END AS source_url FROM mm)
SELECT source_url, g AS geography, 'no period' AS reason FROM u, (VALUES ('sa2'), ('lga'), ('postcode')) v(g) WHERE month(m) = 2
UNION ALL SELECT source_url, 'sa2', 'no code column' FROM u WHERE month(m) = 4
UNION ALL SELECT source_url, 'sa2', 'several sheets' FROM u WHERE month(m) = 6
UNION ALL SELECT source_url, 'postcode', 'no sheet' FROM u WHERE month(m) = 8"""

_PAY_URL = f"'https://data.example.org/dss-demographics-' || {_TOKEN} || '.xlsx'"


def _loaded(table: str, code: str, prefix: str) -> str:
    return f"""
SELECT '{table}' AS table_name, m AS month_date, count(*) AS rows, sum(CASE WHEN c BETWEEN 1 AND 4 THEN 5 ELSE c END) AS total
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, l_returnflag, count(*) AS c
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE CAST({code} AS VARCHAR) LIKE '{prefix}%'
      GROUP BY m, {code}, l_returnflag) GROUP BY m"""


_LOADS = " UNION ALL ".join([_loaded("dss.payment_types_qrt_sa2", "l_suppkey", "2"),
                             _loaded("dss.payment_types_qrt_lga", "(s_nationkey + 19990)", "2"),
                             _loaded("dss.payment_types_qrt_pc", "l_partkey", "3")])

LEDGER = f"""
SELECT table_name, m AS month_date, {_PAY_URL} AS source_url, rows, CAST(total AS DOUBLE) AS total
FROM (SELECT *, month_date AS m FROM ({_LOADS}))"""

NEWEST_LOADED = f"""
SELECT table_name, max(month_date) AS newest, CAST(sum(rows) AS BIGINT) AS rows FROM ({_LOADS}) GROUP BY table_name"""

# First and revised publications of the SA2 sheets; a revision has every third month.
_REVISED = "WITH " + _PAY.format(code="l_suppkey", name="s_name") + f""",
one AS (SELECT m, CAST(code AS VARCHAR) AS code, code AS k, name, series,
               CAST(CASE WHEN c BETWEEN 1 AND 4 THEN 5 ELSE c END AS DOUBLE) AS value
        FROM pl WHERE c > 0 AND CAST(code AS VARCHAR) LIKE '2%'),
every AS (
  SELECT m, 0 AS ord, {_PAY_URL} AS url, code, name, series, value FROM one
  UNION ALL
  SELECT m, 1, replace({_PAY_URL}, '.xlsx', '-revised.xlsx'), code, name, series, value FROM (
    SELECT m, code, name, series, value FROM one WHERE k % 11 <> 0 AND NOT (k % 7 = 0 AND series = 'Age Pension')
    UNION ALL SELECT m, CAST(code AS VARCHAR), name, 'Age Pension', 1234 FROM pay
    WHERE code % 11 <> 0 AND code % 7 = 0 AND CAST(code AS VARCHAR) LIKE '2%'
    UNION ALL SELECT m, '2x' || code, name, 'Age Pension', 7 FROM pay WHERE code % 11 <> 0 AND code % 13 = 0)
  WHERE month(m) % 3 = 0),
pubs AS (SELECT m, ord, url, CAST(row_number() OVER (PARTITION BY m ORDER BY ord) AS INTEGER) AS place
         FROM (SELECT DISTINCT m, ord, url FROM every)),
x AS (SELECT every.*, place FROM every JOIN pubs USING (m, ord))"""

REVISED = _REVISED + """
SELECT n.m AS month_date, n.code AS sa2_5dig, n.name AS sa2_name, n.series, n.url AS source_url, n.place,
       CASE WHEN b.value IS NULL THEN 'inserted' WHEN b.value = n.value THEN 'same' ELSE 'changed' END AS status,
       b.value AS old_value, n.value
FROM x n LEFT JOIN x b ON b.m = n.m AND b.code = n.code AND b.name = n.name AND b.series = n.series AND b.place = n.place - 1
UNION ALL
SELECT b.m, b.code, b.name, b.series, p.url, p.place, 'withdrawn', b.value, NULL
FROM x b JOIN pubs p ON p.m = b.m AND p.place = b.place + 1
WHERE NOT EXISTS (SELECT 1 FROM x n WHERE n.m = b.m AND n.code = b.code AND n.name = b.name AND n.series = b.series
                  AND n.place = p.place)"""

LATEST = _REVISED + """
SELECT code AS sa2_5dig, name AS sa2_name, series, value, m AS month_date, url AS source_url
FROM x WHERE place = (SELECT max(place) FROM pubs WHERE pubs.m = x.m)"""

JOBSEEKER_QUARANTINE = """
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
u AS (SELECT month(m) AS mon, year(m) AS y,
             'https://data.example.org/jobseeker-payment-and-youth-allowance-recipients-monthly-profile-'
             || lower(strftime(m, '%B')) || '-' || strftime(m, '%Y') || '.xlsx' AS url FROM mm)
SELECT 'https://data.example.org/jobseeker-profile-' || y || '.xlsx' AS source_url, 'no period' AS reason FROM u WHERE mon = 2
UNION ALL SELECT url, CASE mon WHEN 4 THEN 'no sheet' WHEN 6 THEN 'no code column' WHEN 8 THEN 'several sheets' ELSE 'no series' END
FROM u WHERE mon IN (4, 6, 8, 10)"""


def _account(geography: str, code: str, prefix: str) -> str:
    return f"""
SELECT m, '{geography}' AS geography, CAST({code} AS VARCHAR) LIKE '{prefix}%' AS ours, {code} % 9 = 0 AS noted,
       {code} % 10 = 0 AS blank, count(*) FILTER (WHERE l_returnflag = 'A') AS a,
       count(*) FILTER (WHERE l_returnflag = 'N') AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r
FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
GROUP BY m, {code}"""


ACCOUNT = f"""
WITH areas AS ({" UNION ALL ".join([_account("sa2", "l_suppkey", "2"), _account("lga", "(s_nationkey + 19990)", "2"),
                                    _account("postcode", "l_partkey", "3")])}),
cells AS (
  SELECT m, geography, ours, unnest([a, n, CASE WHEN noted THEN -1 WHEN blank THEN -2 ELSE r END]) AS c FROM areas),
sums AS (
  SELECT m, geography, count(*) + 3 AS landed, count(*) FILTER (WHERE ours AND c > 0) AS kept,
         count(*) FILTER (WHERE ours AND c BETWEEN 1 AND 4) AS marked, CAST(3 AS BIGINT) AS footnote,
         count(*) FILTER (WHERE NOT ours) AS other_region, count(*) FILTER (WHERE ours AND c = -2) AS empty,
         count(*) FILTER (WHERE ours AND c = -1) AS unparsed, count(*) FILTER (WHERE ours AND c = 0) AS not_positive
  FROM cells GROUP BY m, geography)
SELECT {_PAY_URL} AS source_url, * EXCLUDE (m) FROM sums"""

_RINGS = "sel AS (SELECT a, b FROM range(64) x(a), range(64) y(b) WHERE a <= b)"

OVERLAPPING = f"""
WITH g AS (
  SELECT l_suppkey % 64 AS ring, o_orderpriority AS w, o_orderstatus AS s, CAST(year(o_orderdate) AS INTEGER) AS y,
         sum(CAST(o_totalprice AS DECIMAL(12,2)) * (CAST(l_quantity AS DECIMAL(12,2)) * 0.02)) AS part
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND year(o_orderdate) = year(l_shipdate)
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY ALL),
{_RINGS}
SELECT a || '-' || b AS selection_id, w AS eq_income_weekly, s AS eq_income_yearly,
       CAST(round(sum(part)) AS DOUBLE) AS value, y AS year
FROM sel JOIN g ON ring BETWEEN a AND b GROUP BY ALL"""

# An area (three suppliers) counts in the interval from a to b if the first of its rings from a on is at most b.
OVERLAPPING_INDEX = f"""
WITH reached AS (SELECT DISTINCT l_suppkey // 3 AS part, CAST(year(l_shipdate) AS INTEGER) AS y, l_suppkey % 64 AS ring
                 FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier)),
steps AS (SELECT *, coalesce(lag(ring) OVER (PARTITION BY part, y ORDER BY ring), -1) AS before FROM reached),
sums AS (
  SELECT before, ring, y, substr(p_brand, 1, 7) AS kind, sum(CAST(p_retailprice AS DECIMAL(12,2)) * (part % 97 + 1)) AS top,
         sum(part % 97 + 1) AS bottom
  FROM steps JOIN part p ON p_partkey = part WHERE p_retailprice IS NOT NULL GROUP BY ALL),
{_RINGS}
SELECT a || '-' || b AS selection_id, kind AS seifaindextype, 'SCORE' AS seifa_measure,
       CAST(round(sum(top) / sum(bottom)) AS DOUBLE) AS value, y AS year
FROM sel JOIN sums ON a > before AND a <= ring AND ring <= b GROUP BY ALL"""

FLAT = """
WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
n AS (SELECT DISTINCT c_nationkey FROM customer)
SELECT CAST(c_nationkey AS VARCHAR) AS sheet_name, CAST(r + 3 AS INTEGER) AS row_no, 3 AS n_cells, CAST(c_custkey AS VARCHAR) AS first,
       c_name || ', "' || c_mktsegment || '"' AS second, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS third FROM c
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 1, 1, 'Customers', NULL, NULL FROM n
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 2, 1, NULL, NULL, NULL FROM n
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 3, 3, 'Key', 'Name', 'Again' FROM n"""

HEADER_TYPOS = """
WITH mm AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
y AS (SELECT m, CASE year(m) % 3 WHEN 0 THEN '2003_31' WHEN 1 THEN '2003_39' ELSE strftime(m, '%Y') END AS mark,
             CASE year(m) % 3 WHEN 0 THEN '2002' WHEN 1 THEN '2003' ELSE strftime(m, '%Y') END AS y FROM mm)
SELECT m, lower(strftime(m, '%b')) || '_' || mark AS header,
       CASE month(m) WHEN 3 THEN 'March ' WHEN 6 THEN 'June ' WHEN 9 THEN 'September ' WHEN 12 THEN 'December '
            ELSE lower(strftime(m, '%b')) || '_' END || y AS label,
       CASE WHEN month(m) IN (3, 6, 9, 12) THEN make_date(CAST(y AS BIGINT), month(m), 1) END AS month_date
FROM y"""

LOWER_NAMES = """
SELECT c_custkey AS custkey, c_name AS name, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS acctbal,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment FROM customer"""

ORACLE_SQL = {
    "apportioned_distribution": APPORTIONED,
    "distribution_bucket_rank": BUCKET_RANK,
    "weighted_index": WEIGHTED,
    "area_series_sa2": AS_SA2,
    "area_series_renamed_measure": AS_JOBKEEPER,
    "area_series_postcode": AS_POSTCODE,
    "area_series_sa2_quarterly": AS_SA2_Q,
    "area_series_main_key": AS_MAIN,
    "strip_markers": STRIP,
    "lenient_cast": LENIENT,
    "wide_to_long": WIDE_TO_LONG,
    "paired_header_long": PAIRED,
    "tagged_union": TAGGED,
    "drop_subtotals": SUBTOTALS,
    "period_from_url": PERIOD_FROM_URL,
    "period_repair": PERIOD_REPAIR,
    "current_period_rows": CURRENT_ROWS,
    "newest_period": NEWEST,
    "freshness_gate": GATE,
    "freshness_gate_later": GATE_LATER,
    "append_new_periods": APPEND_NEW,
    "link_inventory": LINKS,
    "link_inventory_scoped": LINKS_SCOPED,
    "newest_link": NEWEST_LINK,
    "pending_publications": PENDING,
    "sheet_pick_check": SHEET_PICK,
    "payment_types_load_sa2": PAY_SA2,
    "payment_types_load_lga": PAY_LGA,
    "payment_types_load_postcode": PAY_PC,
    "jobseeker_load": JOBSEEKER,
    "rental_load_lga": RENTAL_LGA,
    "rental_load_suburb": RENTAL_SUBURB,
    "income_distribution_blocks": INCOME_BLOCKS,
    "seifa_index_blocks": SEIFA_BLOCKS,
    "area_time_series_blocks": SERIES_BLOCKS,
    "clean_header_names": HEADER_NAMES,
    "quarantined_sheets": QUARANTINE,
    "load_ledger": LEDGER,
    "newest_loaded": NEWEST_LOADED,
    "revised_cells": REVISED,
    "latest_publications": LATEST,
    "jobseeker_quarantine": JOBSEEKER_QUARANTINE,
    "load_account": ACCOUNT,
    "sql_income_distribution": INCOME_BLOCKS,
    "sql_seifa_index": SEIFA_BLOCKS,
    "sql_area_series": SERIES_BLOCKS,
    "overlapping_selections": OVERLAPPING,
    "overlapping_index": OVERLAPPING_INDEX,
    "flat_sheets": FLAT,
    "header_typos": HEADER_TYPOS,
    "lower_names": LOWER_NAMES,
}
