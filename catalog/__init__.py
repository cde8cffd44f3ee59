"""Queries over the driver tables, each next to the SQL that checks it."""
