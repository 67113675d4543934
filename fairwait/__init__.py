"""fairwait: how evenly is a public service delivered, measured on Spark.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller acts on the result, except where a docstring says so.
"""

__version__ = "0.1.0"
