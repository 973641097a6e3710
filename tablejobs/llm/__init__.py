"""Operators that prepare text for training language models, each with its own check query."""
