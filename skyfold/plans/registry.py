"""All registered queries: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

from skyfold.plans import archive_queries, calibration_queries, coadd_queries, column_queries, map_queries, source_queries, stat_queries
from skyfold.plans.views import Query

REGISTERED: dict[str, Query] = {}
for _module in (coadd_queries, calibration_queries, column_queries, map_queries, stat_queries, archive_queries, source_queries):
    for _name, _query in _module.QUERIES.items():
        if _name in REGISTERED:
            raise ValueError(f"query registered twice: {_name}")
        REGISTERED[_name] = _query
