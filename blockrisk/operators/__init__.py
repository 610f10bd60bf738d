"""DataFrame-level operators: spatial joins, distributed ranking, panels, aggregates."""
