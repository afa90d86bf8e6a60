"""Plumeline: multi-source sensor-observation analytics as plain Spark DataFrames.

Layers
------
``functions``  column expressions (no actions, no UDFs)
``sources``    readers, landing, staging and the Parquet table store
``operators``  DataFrame-in / DataFrame-out relational operators
``plans``      compositions: batch load, rebuild, mart refresh, serving queries
``streaming``  Structured Streaming ingest on top of the same operators
``catalog``    registered queries over the sample tables, with their SQL oracles
"""
