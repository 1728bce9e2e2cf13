"""Baseball analytics on Spark: pitch search, arsenals, spin physics, boards, entities, feeds.

Every operator takes DataFrames and column names and returns a DataFrame, so the same
code runs on landed pitch rows, landed boards and landed API payloads of any size.
"""

__version__ = "0.1.0"
