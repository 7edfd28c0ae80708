"""Whole cleaning runs, their configuration and the queries over them."""
