"""Commerce analytics operators on Spark DataFrames.

Every operator is a plain function from DataFrames (or Columns) to a DataFrame
(or a Column).  Nothing reads the clock: "today" is always an ``as_of`` argument.
"""
