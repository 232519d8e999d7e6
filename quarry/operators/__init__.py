"""DataFrame operators: quality, cleaning, aggregates, windows, joins,
ordering, encoding, evaluation and models."""
