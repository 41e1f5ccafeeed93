"""Operators for preparing language-model training text, one module each."""
