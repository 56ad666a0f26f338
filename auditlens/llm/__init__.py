"""Operators for preparing training text (documents in, decisions out)."""
