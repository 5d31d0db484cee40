"""cellmart: mobile-network usage analytics as Spark DataFrame jobs.

Layout
------
functions/  Column -> Column helpers (calendar keys, text normalisation, ordered rules)
operators/  DataFrame -> DataFrame operators (joins, rank-first, pivots, upserts, quality)
sources/    scans of delimited landing files, manifests, file counts, control tables
sinks/      append / refresh / partitioned writes, CSV and text sinks, retention
plans/      marts composed from the operators, plus the role adapter for the driver tables
streaming/  incremental landing ingest with Structured Streaming

Every date-dependent step takes an explicit ``as_of`` date instead of reading the clock.
"""

from cellmart.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
