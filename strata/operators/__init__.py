"""DataFrame -> DataFrame operators (cleaning, joins, aggregates, ranking, measurement)."""
