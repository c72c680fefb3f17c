"""Operators for preparing training text: each is a function from DataFrame to DataFrame."""
