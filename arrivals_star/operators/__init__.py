"""DataFrame → DataFrame operators: profile, clean, conform, joins, dimensions, fact, aggregates."""
