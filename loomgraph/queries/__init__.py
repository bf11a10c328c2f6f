"""Queries over the test tables, with DuckDB SQL for the same rows."""
