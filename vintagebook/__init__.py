"""vintagebook: monthly feature books, labels and scorecard tooling on Spark DataFrames.

Every public operator takes DataFrames (or Columns) and returns DataFrames
(or Columns); nothing is pulled to the driver except small fitted state
(bin edges, category lists, k x k matrices) whose size is bounded by the
number of columns or bins, never by the number of rows.
"""

__version__ = "0.1.0"
