"""tickwise: tick analytics and alerting on Spark DataFrames.

Sub-packages:

* ``functions``  column expressions (time of day, metrics, deviation, JSON)
* ``operators``  DataFrame -> DataFrame operators (parse, windows, history,
  alerts, feeds)
* ``sources``    tick tables, readers and writers (parquet, JSON text, Kafka
  and JDBC option builders, keyed sinks)
* ``plans``      composed jobs, fixtures and the query registry
* ``streaming``  Structured Streaming jobs (count window with state,
  stream-static alerts, incremental feeds, micro-batch ingest)
"""

__version__ = "0.1.0"
