"""Whole runs: datasets, pipeline, command line."""
