"""DataFrame -> DataFrame operators: filters, joins, ranking, nearest station."""
