"""The registered queries: one per operator, with the SQL that must give the same rows."""

from workload import (
    clean_queries,
    feature_queries,
    frequency_queries,
    metric_queries,
    model_queries,
    profile_queries,
    recode_queries,
    source_queries,
)
from workload.tables import Query

MODULES = (
    source_queries,
    profile_queries,
    recode_queries,
    frequency_queries,
    clean_queries,
    feature_queries,
    model_queries,
    metric_queries,
)

ALL: dict[str, Query] = {}
for _module in MODULES:
    _again = ALL.keys() & _module.QUERIES.keys()
    if _again:
        raise ValueError(f"registered twice: {sorted(_again)}")
    ALL.update(_module.QUERIES)
