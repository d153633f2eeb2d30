"""Ordered bucket labels -> sort rank (first matching rule wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: weekly equivalised income buckets and their sort rank, in
# the order the rules are tried.  A label listed under two ranks takes the
# first; labels not listed get no rank and sort last.
INCOME_WEEKLY_RANKS = [
    (1, ["Negative income"]),
    (2, ["Nil income"]),
    (3, ["1-149", "1-199"]),
    (4, ["150-299", "200-299"]),
    (5, ["300-399"]),
    (6, ["400-499", "400-599"]),
    (7, ["500-649", "600-799"]),
    (8, ["650-799", "800-999"]),
    (9, ["800-999", "1,000-1,249"]),
    (10, ["1,000-1,249", "1,250-1,499"]),
    (11, ["1,250-1,499", "1,500-1,999"]),
    (12, ["1,500-1,749", "2,000 or more"]),
    (13, ["1,750-1,999"]),
    (14, ["2,000-2,499"]),
    (15, ["2,500-2,999"]),
    (16, ["3,000 or more"]),
    (17, ["Not stated"]),
    (18, ["Partial income stated"]),
    (19, ["All incomes not stated"]),
    (20, ["Not applicable"]),
]
# ---------------------------------------------------------------------------


def bucket_rank(col, rules=INCOME_WEEKLY_RANKS) -> Column:
    """Rank of a bucket label: the first rule listing the label wins; NULL if
    no rule lists it.  One CASE expression, evaluated inside codegen."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for rank, labels in rules:
        cond = c.isin(list(labels))
        expr = F.when(cond, F.lit(rank)) if expr is None else expr.when(cond, F.lit(rank))
    return expr.cast("int")
