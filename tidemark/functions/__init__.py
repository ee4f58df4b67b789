"""Column expressions: text clean-up, table names, dates and type rules."""
