"""Layer operators: Bronze load, Silver extraction/dedupe, staging views and
data-quality checks. Each is a pure ``DataFrame -> DataFrame`` function; the
same function runs in a batch job and inside a streaming ``foreachBatch``."""
