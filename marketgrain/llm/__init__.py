"""Operators for preparing training text at scale, with the queries that apply them."""
