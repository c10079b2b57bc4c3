"""Inputs built from the test tables and the SQL which each query is checked against."""
