"""DataFrame in, DataFrame out: cleaning, projections, joins, unions, aggregates, graphs."""
