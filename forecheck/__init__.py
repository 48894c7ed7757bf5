"""forecheck: retail forecast validation as Spark DataFrame jobs.

Layout
------
``sources``    role tables (named-table scans, the driver-table fixture adapter, report sinks)
``functions``  column-level helpers (fiscal weeks, product paths, safe arithmetic)
``operators``  DataFrame -> DataFrame transformations, one per business step
``plans``      end-to-end report composition, query registry and SQL oracle twins
"""

from forecheck.config import ReportParams, WeekRange

__all__ = ["ReportParams", "WeekRange"]
