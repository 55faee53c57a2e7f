"""Operators for preparing language-model training data.

Nothing else in the library imports this folder. Every operator takes and returns DataFrames;
its module's docstring names the method and what it does with nulls, empty texts and ties.
"""
