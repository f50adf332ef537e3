"""Whole reports and the query catalog."""
