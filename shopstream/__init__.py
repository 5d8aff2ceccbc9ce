"""shopstream: real-time retail analytics as PySpark DataFrame operators.

Layout
------
sources/    topic (Kafka or directory) reads and the driver-table adapters
functions/  column expressions: time parts, masks, age, doc ids, JSON
operators/  DataFrame -> DataFrame operators: parse, cdc, ingest, dedupe,
            alerts, joins, kpi
sinks/      keyed upsert and append writers (batch and foreachBatch)
streaming/  Structured Streaming jobs that wire the operators together
plans/      the registered query plans over the driver tables
"""

__all__ = ["session"]
