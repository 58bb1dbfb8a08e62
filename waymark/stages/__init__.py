"""Batch stages: each takes DataFrames and gives the next table; writing is left to the sinks."""
