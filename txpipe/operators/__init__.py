"""DataFrame operators: windows, labels, joins, aggregates, metrics, models."""
