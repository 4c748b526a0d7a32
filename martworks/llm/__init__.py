"""Operators for preparing text corpora: one module per operator."""
