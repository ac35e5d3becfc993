"""Reading contracts and tables, and writing tables."""
