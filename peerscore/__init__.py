"""Peer-group scorecards on Spark: dated multi-table model, peer-relative scores,
in-group ranks, keyed upserts, comparison queries and capture extraction."""

__version__ = "0.1.0"
