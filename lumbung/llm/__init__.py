"""Operators for text corpora and for linking free text to known entities. Nothing outside this package imports it."""
