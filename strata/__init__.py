"""strata: versioned entity documents turned into queryable validity-interval histories, on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark's own
expressions; column names are arguments.
"""

from .operators.asof import AsOfSpec, interval_chain, interval_join, start_match_chain, start_match_join
from .operators.history import Field, HistorySpec, distinct_starts, explode_history, reopen_orphans
from .operators.layout import cluster, materialize
from .operators.ranking import first_per_key, latest_per_key, top_per_key

__all__ = [
    "AsOfSpec",
    "Field",
    "HistorySpec",
    "cluster",
    "distinct_starts",
    "explode_history",
    "first_per_key",
    "interval_chain",
    "interval_join",
    "latest_per_key",
    "materialize",
    "reopen_orphans",
    "start_match_chain",
    "start_match_join",
    "top_per_key",
]
