"""linkflow: Spark-native link travel-time telemetry engine.

Raw message dumps (JSON lines, Kafka topics or frames derived from a table)
are refined into bronze, silver, de-duplicated silver, a link dimension and
an interval fact table, then aggregated into delay windows, pipeline
monitoring, consumer lag, landing health and dashboard summaries.  Every
transformation is a DataFrame -> DataFrame function built from Spark
built-ins, usable in batch and in Structured Streaming.
"""

from linkflow.session import build_session, prepare_session, scratch_root

__all__ = ["build_session", "prepare_session", "scratch_root"]
