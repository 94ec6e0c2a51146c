"""Operators that prepare language-model training text; nothing outside this package imports it."""
