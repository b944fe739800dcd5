"""Service call graphs from distributed-tracing spans, on Spark DataFrames."""
