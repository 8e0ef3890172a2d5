"""Reading and writing tables, models and staged data."""
