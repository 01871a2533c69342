"""DataFrame operators: rolling features, joins in time, quality, drift, monitoring."""
