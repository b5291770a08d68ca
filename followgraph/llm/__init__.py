"""Operators for preparing language-model training data (ten operators and
the queries that apply them); nothing else in the library imports this."""
