"""arealens: small-area statistics as Spark DataFrame operators.

Read side: answer questions about a set of city blocks through block-to-area
concordance tables (apportioned sums, population-weighted index averages,
area time-series lookups).  Load side: turn published wide sheets into tidy
long series and append only periods that are not stored yet.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` built from
built-in expressions, so Catalyst plans it and AQE picks join strategies from
runtime sizes.
"""

from arealens.operators.area import apportioned_distribution, area_series, weighted_index
from arealens.operators.gate import (current_period_rows, freshness_gate, new_periods_only,
                                     newest_period)
from arealens.plans.catalog import (area_time_series, income_distribution, run_jobseeker_load,
                                    run_payment_types_load, run_rental_load, seifa_index)
from arealens.plans.jobseeker import load_jobseeker
from arealens.plans.payment_types import load_payment_types, load_payment_types_all
from arealens.plans.publications import pending_publications
from arealens.plans.rental import load_rental, load_rental_all
from arealens.session import checkpoint_dir, get_session, use_policy
from arealens.sources.links import first_link, link_inventory, newest_link
from arealens.sources.tables import append_table, read_table
from arealens.streaming.landing import incremental_load

__all__ = [
    "apportioned_distribution", "area_series", "weighted_index",
    "current_period_rows", "freshness_gate", "new_periods_only", "newest_period",
    "area_time_series", "income_distribution", "seifa_index",
    "run_jobseeker_load", "run_payment_types_load", "run_rental_load",
    "load_jobseeker", "load_payment_types", "load_payment_types_all", "load_rental",
    "load_rental_all", "pending_publications",
    "checkpoint_dir", "get_session", "use_policy",
    "first_link", "link_inventory", "newest_link", "append_table", "read_table",
    "incremental_load",
]
