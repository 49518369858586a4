"""Table scans and sinks, and the model derived from the test tables."""
