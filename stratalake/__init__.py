"""stratalake: versioned reference data on plain Spark DataFrames.

Every operator is a function from DataFrames to DataFrames.  Operators are lazy,
apart from gates, writers, the lookup of hot keys and the few that write a result
once because they read it repeatedly; each says so in its docstring.
"""

__version__ = "0.1.0"
