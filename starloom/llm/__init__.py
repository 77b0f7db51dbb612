"""Operators for preparing training text and searching vectors; nothing else in the library imports them."""
