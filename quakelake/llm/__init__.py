"""Operators for training data: cleaning, near copies, mixing, tokens and packing.

Nothing else in the library imports this package. Every operator takes the columns it needs by
exact name, so other columns, clashing names among them, never reach its plan.
"""
