"""Operators for the preparation of training text; nothing else in the package imports this folder."""
