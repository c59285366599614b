"""Registered queries over the supplied tables, each next to its check SQL."""
