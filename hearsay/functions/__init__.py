"""Column helpers: each takes Columns and returns a Column, no Python UDFs."""
