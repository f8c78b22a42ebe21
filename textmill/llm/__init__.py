"""Operators for language-model training data. Nothing else in textmill imports this package."""
