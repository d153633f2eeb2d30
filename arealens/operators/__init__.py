"""DataFrame -> DataFrame operators."""

from arealens.operators.area import (AREA_SERIES_SPECS, SeriesSpec, apportioned_distribution,
                                     area_series, weighted_index)
from arealens.operators.selection import (bounded_broadcast, block_ids, check_members,
                                          select_blocks)

__all__ = ["AREA_SERIES_SPECS", "SeriesSpec", "apportioned_distribution", "area_series",
           "weighted_index", "bounded_broadcast", "block_ids",
           "check_members", "select_blocks"]
