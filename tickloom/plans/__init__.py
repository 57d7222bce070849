"""Whole plans: calls, their ledger, reports, and the queries over the test tables."""
