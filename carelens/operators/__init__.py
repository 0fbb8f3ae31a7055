"""DataFrame → DataFrame operators: cleaning, filters, aggregates, joins."""
