"""tidemark: change-data analytics on Spark.

Layers: Kafka-shaped change records -> bronze (decoded envelopes) -> silver
(current state per key, soft deletes, keyed merge) -> gold (star-schema facts and
summaries) -> KPIs, plus data-quality reports.  Everything is expressed with the
DataFrame API and built-in expressions; no UDFs.
"""

__version__ = "0.1.0"
