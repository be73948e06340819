"""Plans: the reference's jobs composed from operators, and the query registry."""
