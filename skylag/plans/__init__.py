"""Whole jobs, views of the test tables, and the checked queries."""
