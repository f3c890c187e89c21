"""Reading sources, writing tables, publishing them for SQL."""
