"""Column-level functions (Column in, Column out), all built-in expressions."""

from arealens.functions.period import (extract_period, expand_header_month, fix_header_typos,
                                       newest_label, period_to_date,
                                       repair_period_label, sentence_case, title_case,
                                       url_has_period)
from arealens.functions.text import (clean_header_names, lenient_number, strip_marker)
from arealens.functions.rank import INCOME_WEEKLY_RANKS, bucket_rank

__all__ = [
    "extract_period", "expand_header_month", "fix_header_typos", "newest_label", "period_to_date", "repair_period_label", "sentence_case", "title_case",
    "url_has_period", "clean_header_names", "lenient_number", "strip_marker",
    "INCOME_WEEKLY_RANKS", "bucket_rank",
]
