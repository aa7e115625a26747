"""Analytic operators over trip records and text, written with the DataFrame API."""
