"""fraudlens: order ingest, fraud flagging and order analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst plans it, nothing runs on the driver.

Layout
------
- ``schemas``      declared StructTypes of the wire format and the tables
- ``functions``    column expressions (amount cleaning, fraud rules, formats)
- ``operators``    DataFrame operators (ingest, staging, core, marts, merges)
- ``sources``      readers / writers (order topic, warehouse tables, adapter)
- ``streaming``    Structured Streaming ingest
- ``plans``        the model graph (staging -> core -> marts) and its runner
"""

from fraudlens.session import get_session

__all__ = ["get_session"]
