"""Whole jobs made of the operators, one module per kind of input.

Every function takes the input tables as DataFrames and gives a DataFrame, or a
fitted model where that is the result. Input schemas are in FIXTURES.md.
"""
