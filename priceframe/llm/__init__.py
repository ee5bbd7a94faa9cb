"""Operators for building language-model training data, each with its registered query."""
