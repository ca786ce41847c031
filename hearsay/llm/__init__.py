"""Operators for preparing training text: deduplication, cleaning, labelling, mixing and formatting."""
