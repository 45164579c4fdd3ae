"""Operators for preparing language-model training data.

Every operator takes and returns DataFrames, names its columns by parameter and
states in its docstring what it does with nulls, empty and repeated rows.
"""
