"""Training-data operators: thirteen corpus operators built on the DataFrame API.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and column names, accepts extra columns under any name and states
its results for nulls, empty texts, ties and repeated rows in its docstring.
"""
