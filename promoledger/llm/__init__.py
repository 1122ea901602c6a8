"""Operators for large training-data pipelines, their queries and the SQL they are checked against."""
