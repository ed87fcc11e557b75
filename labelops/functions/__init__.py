"""Column-level rules: tokens, quality gates, geometry, scores and routes."""
