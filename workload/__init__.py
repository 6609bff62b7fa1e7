"""Transactions derived from the test tables, and the SQL the results are checked with."""
