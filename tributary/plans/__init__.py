"""Whole flows: the load run and the reports."""
