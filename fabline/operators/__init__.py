"""DataFrame operators: filters, joins, aggregates, ordered folds, kNN."""
