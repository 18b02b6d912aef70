"""Column-level building blocks: time, predicates, projections, metric aggregates."""
