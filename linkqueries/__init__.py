"""Queries over the star-schema test tables that exercise privlink, with their DuckDB SQL.

Not part of the library: the driver contract, the benchmark and the tests use it.
"""
