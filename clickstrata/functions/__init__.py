"""Column expressions: cleaning, identifiers, request lines, conditional aggregates."""
