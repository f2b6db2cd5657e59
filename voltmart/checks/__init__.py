"""Registered queries, each next to the DuckDB SQL that must give the same rows."""
