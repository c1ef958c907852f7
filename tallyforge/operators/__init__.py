"""Relational operators: state changes, stages of the count, and its summaries."""
