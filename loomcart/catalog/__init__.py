"""Registered queries over the given test tables, with the SQL they are checked against."""
