"""Operators for preparing training text: cleaning, removing repeats, scoring, search, tokens and packing."""
