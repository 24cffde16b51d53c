"""Operators that prepare corpora for language models."""
