"""Operators: pure functions from DataFrames to DataFrames. None runs an action unless its docstring says so."""
