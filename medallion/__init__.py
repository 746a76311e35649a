"""medallion — a Spark-native event-to-star-schema engine.

Layers (see README): Bronze (raw NDJSON -> VARIANT with a per-file reject
gate), Silver (typed, exactly-once-by-event_id tables), staging views, Gold
dimensions, facts and marts, and data-quality checks that run as Spark jobs.
"""

__version__ = "0.1.0"
