"""Composed plans: derived views over the test tables and the query catalog."""
