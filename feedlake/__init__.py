"""feedlake: feed curation on Spark.

Every operator is a function from DataFrame(s) to a DataFrame, keyed by
``run_ts`` (daily selection) or ``week`` (weekly rollups), so one job can serve
a single run or a backfill of years.
"""

__version__ = "0.1.0"
