"""Operators that prepare training text: scoring, mixing, decontamination, encoding, near copies, filters, search."""
