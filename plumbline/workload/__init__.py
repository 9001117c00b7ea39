"""Entities derived from the supplied tables, queries over them, and their SQL twins."""
