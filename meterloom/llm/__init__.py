"""Operators on text corpora: quality, duplicates, filters, mixing and token output."""
