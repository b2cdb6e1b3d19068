"""Layered (raw -> staging -> warehouse -> marts) data flows as Spark DataFrame operators.

Operators are functions from DataFrames to the next state of a table.  Only
``sources`` and ``streaming`` touch storage.  "Now" is always an argument.
"""
