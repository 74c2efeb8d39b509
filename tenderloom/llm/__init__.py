"""Operators that prepare text records for the training of language models."""
