"""Whole jobs: files in, reports out."""
