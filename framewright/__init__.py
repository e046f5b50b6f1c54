"""framewright: table and stream operators expressed with the PySpark DataFrame API.

Every operator is a lazy function from DataFrames (or Columns) to a DataFrame (or Column).
Nothing here creates a session, collects rows, caches, or changes configuration unless the
function's name and docstring say so.
"""

__version__ = "0.1.0"
