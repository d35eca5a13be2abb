"""urbanlens — PySpark-native trip, sensor and rating analytics.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from the DataFrame API, so Catalyst sees the whole plan: filters reach the
Parquet scan, unused columns are pruned, aggregations run partial + final, and
only tables with a proven size bound are broadcast.

Layout
------
``sources``    readers, sinks and the driver test-data views
``functions``  scalar ``Column`` expressions (parsing, bins, vectors, hashing)
``operators``  cleaning, enrichment joins, profiles, quality, KPIs, sampling,
               recommendations, ML
``plans``      the composite jobs and the query catalogue
``streaming``  incremental (file-stream) variant of trip cleaning
"""

from urbanlens.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
