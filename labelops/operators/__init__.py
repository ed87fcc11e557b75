"""DataFrame-level operators: deduplication, splits, checks, metrics, audits, learning."""
