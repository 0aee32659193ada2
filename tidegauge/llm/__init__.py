"""Operators for preparing text corpora, their queries and their SQL."""
