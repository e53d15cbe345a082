"""Jobs: the daily runs assembled from operators, with their sinks."""
