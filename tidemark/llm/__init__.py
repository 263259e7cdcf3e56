"""Operators that prepare a text corpus for model training. Nothing else in the library imports this package."""
