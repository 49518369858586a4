"""Incremental (micro-batch) runner of the daily scorecard."""
