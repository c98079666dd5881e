"""Checked queries over the given tables, one per operator, each with its SQL twin.

Where the tables hold no portal page, a query first writes one from a table's columns,
row by row, and then runs the operator on it; the SQL reads the columns themselves.
"""
