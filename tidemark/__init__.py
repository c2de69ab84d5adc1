"""Incremental table replication and change capture on Spark DataFrames."""
