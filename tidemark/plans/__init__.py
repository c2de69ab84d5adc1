"""Stored targets and whole runs."""
