"""Whole runs: the default nine-stage plan and the reports over its rows."""
