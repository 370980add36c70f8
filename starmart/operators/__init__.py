"""DataFrame operators: events, keys, joins, dimensions, bridges, facts and chart series."""
