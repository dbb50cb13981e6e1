"""Check queries over the synthetic tables, with the SQL each one must equal."""
