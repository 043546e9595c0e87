"""DataFrame -> DataFrame operators: filters, joins, aggregates, windows,
sampling, set operations and the corpus-level alignment jobs."""
