"""barlake: open/high/low/close/volume bar analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL column expressions, so Catalyst sees one declarative plan from
the Parquet/CSV/JSON scan to the result.  Sub-packages:

* ``sources``   - table adapters, file/JDBC/stream readers and writers
* ``functions`` - reusable column expressions (trading day, safe ratios,
  display formatting)
* ``operators`` - cleansing, dedup/retention, catalog, windows,
  indicators, trend models, intraday views
* ``plans``     - the published datasets composed from operators
* ``streaming`` - Structured Streaming ingest, idempotent sinks, keyed state
"""

from barlake.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
