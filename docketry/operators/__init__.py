"""DataFrame-to-DataFrame operators: row generators, joins, aggregates, write modes."""
