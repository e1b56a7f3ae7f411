"""Reusable DataFrame operators: quality gates, profiling, quantile scoring, top-k,
skew-safe joins."""
