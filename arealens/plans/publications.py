"""Which publications still need loading: page -> newest link -> gate.

The scheduled loads start from the publisher's page: list its links, take
the first matching one as the newest publication, and load it only when the
stored table does not have its period yet.  Over a ``pages`` table this is
one map-only pass per page plus a scalar subquery for the newest stored
period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from arealens.operators.gate import freshness_gate
from arealens.sources.links import first_link


def pending_publications(pages: DataFrame, stored: DataFrame, keep: str | None = None,
                         container: str | None = None, prefix=None, date_col: str = "month_date",
                         mode: str = "later", period=None) -> DataFrame:
    """(page_id, href, link_no, newest..., already_loaded) for each page's
    newest matching link.  ``mode="later"`` (default) compares the link's
    period - ``period``, a Column computed from ``href``, or what the payment
    file names' pattern finds in it - with the newest stored one."""
    links = first_link(pages, keep=keep, container=container, prefix=prefix)
    if mode == "later" and period is not None:
        links = links.withColumn("period", period)
        return freshness_gate(links, stored, "href", period_col="period", date_col=date_col,
                              mode="later")
    return freshness_gate(links, stored, "href", date_col=date_col, mode=mode)
