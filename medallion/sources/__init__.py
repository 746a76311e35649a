"""Sources and sinks: NDJSON files (batch and stream), the product seed, and
the driver-table fixture that renders test tables as domain events."""
