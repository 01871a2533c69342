"""Ready queries over the given tables, each with the same question as plain SQL."""
