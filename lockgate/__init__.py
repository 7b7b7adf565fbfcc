"""Data-quality gates, quarantine, drift, history and trends for layered Spark tables."""
