"""hexloom: hex-grid spatial analytics and data preparation on Spark.

Everything is a function from DataFrames to a DataFrame; nothing runs until the
caller acts on the result, except where a docstring says a step is written to the
shared folder (see :mod:`hexloom.session`).
"""

__version__ = "0.1.0"
