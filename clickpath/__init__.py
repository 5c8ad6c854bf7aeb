"""clickpath: click-stream and ad-click analytics as PySpark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst plans it (pushdown, pruning, partial aggregation) and
the same function serves a batch table and the inside of a streaming
``foreachBatch``.

Sub-packages:

* ``sources``   - table readers, fixture adapters, ad-log line parse/format
* ``functions`` - scalar Column helpers (time format/parse, Java-style split, JSON)
* ``operators`` - filters, aggregates, windows, top-k (the report building blocks)
* ``sinks``     - table/JDBC writers and replay-safe keyed logs
* ``streaming`` - Structured Streaming jobs (file/Kafka sources, foreachBatch)
* ``plans``     - complete reports (compositions) and the query catalog
"""

__version__ = "0.1.0"
