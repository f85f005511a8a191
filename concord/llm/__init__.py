"""Operators for preparing training text: ten numbered operators and their queries."""
