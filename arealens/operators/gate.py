"""Incremental load control: newest stored period, freshness gate, new rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.period import (PAYMENT_PERIOD_PATTERN, extract_period, newest_label, period_to_date,
                                       repair_period_label, sentence_case, url_has_period)
from arealens.operators.selection import bounded_broadcast


def newest_period(stored: DataFrame, date_col: str | None = "month_date",
                  label_col: str | None = None) -> DataFrame:
    """One row: ``newest`` (lower-case "december-2019"), ``newest_date`` and
    ``unparsed`` (labels that could not be read as a period).

    Reads the stored date column when there is one (a max over one column,
    pruned to that column in the scan); otherwise parses ``label_col``.
    """
    d = F.col(date_col) if date_col else period_to_date(label_col)
    bad = (F.count_if(d.isNull() & F.col(label_col).isNotNull()) if label_col
           else F.lit(0).cast("bigint"))
    return stored.agg(newest_label(d).alias("newest"),
                      F.max(d).alias("newest_date"),
                      bad.alias("unparsed"))


def freshness_gate(candidates: DataFrame, stored: DataFrame, url_col: str = "url",
                   period_col: str | None = None, date_col: str = "month_date",
                   mode: str = "later", pattern: str = PAYMENT_PERIOD_PATTERN) -> DataFrame:
    """Mark each candidate publication as ``already_loaded`` or not.

    mode="later" (default): load only when the candidate's period is after the
        newest stored date.  The period is ``period_col`` (a date) or, without
        one, what ``pattern`` finds in the URL.
    mode="contains": loaded when the URL names the newest stored period, the
        published rule with both sides normalised: "dec-2019" and
        "december-2019" are one period.
    A candidate without a period is never marked as loaded.  The newest period
    is a scalar subquery: computed once, no join.
    """
    newest = newest_period(stored, date_col)
    named = repair_period_label(sentence_case(extract_period(url_col, pattern)))
    if mode == "contains":
        label = newest.select("newest").scalar()
        flag = F.coalesce(url_has_period(url_col, label), F.lit(False)) | F.coalesce(
            F.lower(named) == label, F.lit(False))
        return candidates.withColumn("newest", label).withColumn("already_loaded", flag)
    if mode == "later":
        nd = newest.select("newest_date").scalar()
        period = F.col(period_col) if period_col else period_to_date(named)
        flag = F.coalesce(period <= nd, F.lit(False))
        return candidates.withColumn("newest_date", nd).withColumn("already_loaded", flag)
    raise ValueError("mode should be 'contains' or 'later'")


def new_periods_only(incoming: DataFrame, stored: DataFrame, key="month_date") -> DataFrame:
    """Rows of ``incoming`` whose key (period, or period and publication) is not
    stored yet.  The stored side is reduced to its distinct keys, broadcast
    where a count shows them few, so the incoming rows are not shuffled on a
    handful of periods.  NULL keys match each other: re-running a load adds
    nothing."""
    keys = [key] if isinstance(key, str) else list(key)
    known = stored.select(*[F.col(k).alias(f"__stored_{k}") for k in keys]).distinct()
    match = [F.col(k).eqNullSafe(F.col(f"__stored_{k}")) for k in keys]
    return incoming.join(bounded_broadcast(known), match, "left_anti")


def current_period_rows(df: DataFrame, period_col: str, periods) -> DataFrame:
    """Keep rows of the given period label(s) and drop exact duplicates.
    ``periods`` is a list of labels or a one-column DataFrame of labels, which
    is broadcast where a count shows it small: the rows are then filtered
    where they are read and only the kept ones meet the DISTINCT."""
    if isinstance(periods, DataFrame):
        p = bounded_broadcast(periods.toDF(period_col).distinct())
        kept = df.join(p, period_col, "left_semi")
    else:
        kept = df.filter(F.col(period_col).isin(list(periods)))
    return kept.distinct()
